"""DataFrame operators: split, preprocessing, statistics, training, metrics, reports."""
