"""No stream processing: every input is a finite table."""
