"""Toxicity: a weighted lexicon, matched by Aho-Corasick after folding.

Folding: lower case; look-alike letters of other scripts become Latin ones and accents go; in words
that mix letters with digits or signs, digits and signs inside become the letters they stand for.
Terms count as whole words. A term inside an exception phrase ("trash can") does not count.

The lexicon is learned from a bounded sample of labelled documents: words, and beginnings of words
(four to eight letters), that are surely more frequent in toxic ones. A term's weight is the lower
bound of its log-odds. A short fixed lexicon adds words that the sample does not hold at all.
Exception phrases are learned too: a term with the word before or after it, where the documents that
hold this pair are toxic no more often than documents are at large; a few fixed ones are added.

The greatest weight in a document, the sum of its weights, and that sum by length go into a logistic
curve. It is fitted on inputs that no document had a part in: the sample has two halves, and each
half's inputs come from the lexicon and exceptions of the other one.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common, labels as lab
from linfold.llm.textbytes import Texts, chunks

MIN_DOCS, MIN_ODDS, STEMS = 5, 2.0, range(4, 9)
# A short lexicon of English insults, and phrases in which some of them are harmless.
LEXICON = (
    "arrogant airhead bastard bonehead bootlicker brainless buffoon bum chump clown coward crap creep "
    "cretin crook degenerate dimwit dirtbag disgrace disgusting dolt dope dork dumb dumbass dummy dunce "
    "filth filthy fool fraud freak garbage halfwit hypocrite idiot idiotic ignorant imbecile incompetent "
    "jackass jerk liar lame loser lowlife lunatic maggot moron moronic nitwit numbskull oaf parasite "
    "pathetic pervert pig pinhead psycho punk rat repulsive retard revolting ridiculous scum scumbag "
    "simpleton sleazy slime slob snake stupid sucker swine thug trash troll twit ugly useless vermin vile "
    "weakling weirdo wimp worthless").split()
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "garbage can", "garbage truck", "garbage collection",
              "class clown", "clown fish", "circus clown", "sore loser", "pond scum", "soap scum",
              "stupid question", "guinea pig", "lab rat", "rat race", "lame duck", "dumb waiter", "dumb bell",
              "fool proof", "punk rock", "freak accident", "ugly duckling", "snake bite")
# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһкмнтвгпαεορυνικτβηρι", "aeopcyxijsdhkmhtbrnaeopyviktbhpi")
SIGNS = str.maketrans("013457@$!|8", "oieastasiib")
MIXED = re.compile(r"(?<![a-z0-9@$!|])[a-z0-9@$!|]*(?:[a-z][0-9@$!|]+|(?<![a-z0-9@$!|])[0-9@$!|]+)[a-z][a-z0-9@$!|]*")
SIGN_IN_WORD = re.compile(r"[0-9@$!|][a-z]")
TAIL = re.compile(r"[@$!|]+$")
WORD = re.compile(r"[^\W\d_]+")
LAST_WORD = re.compile(r"(?<![^\W_])([^\W\d_]+) \Z")
LONGEST_BEFORE = 40   # letters looked back for the word before a term; a longer one makes no phrase


def _fold_word(match: re.Match) -> str:
    word = match[0]
    tail = TAIL.search(word)
    end = tail.start() if tail else len(word)
    return word[:end].translate(SIGNS) + word[end:]


def fold(text: str) -> str:
    """``text`` as the lexicon sees it."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(LOOKALIKES))
        text = "".join([c for c in text if not unicodedata.combining(c)]) if not text.isascii() else text
    return MIXED.sub(_fold_word, text) if SIGN_IN_WORD.search(text) else text


def terms_of(folded: str) -> set[str]:
    """A text's words, and the beginnings of its words marked by a star."""
    words = set(WORD.findall(folded))
    return words | {w[:k] + "*" for w in words for k in STEMS if k < len(w)}


class Matcher:
    """Occurrences of a lexicon's terms in folded texts. A term with a star is a beginning."""

    MOST_KEPT = 3
    _made: dict[tuple, Matcher] = {}

    @classmethod
    def get(cls, lexicon: tuple[str, ...], exceptions: tuple[str, ...] = EXCEPTIONS) -> Matcher:
        """The automata of the last lexicons of a worker."""
        key = lexicon, exceptions
        if key not in cls._made:
            if len(cls._made) == cls.MOST_KEPT:
                cls._made.clear()
            cls._made[key] = cls(lexicon, exceptions)
        return cls._made[key]

    def __init__(self, lexicon: tuple[str, ...], exceptions: tuple[str, ...] = EXCEPTIONS):
        import ahocorasick

        found: dict[str, list[int]] = {}
        for i, term in enumerate(lexicon):
            found.setdefault(term.rstrip("*"), [-1, -1])[term.endswith("*")] = i
        for phrase in exceptions:
            found.setdefault(phrase, [-1, -1])
        self.harmless = set(exceptions)
        self.automaton = ahocorasick.Automaton()
        for key, (whole, start) in found.items():
            self.automaton.add_word(key, (key, whole, start))
        self.automaton.make_automaton()

    def count(self, folded: str) -> dict[int, int]:
        """Number of occurrences of each term, outside exception phrases."""
        out: dict[int, int] = {}
        for _, i in self.hits(folded):
            out[i] = out.get(i, 0) + 1
        return out

    def phrases(self, folded: str) -> set[str]:
        """The words that hold a term outside exception phrases, each with the word one space before
        it and with the word one space after it."""
        found = set()
        for begin in {begin for begin, _ in self.hits(folded)}:
            word = WORD.match(folded, begin)
            if word is None:
                continue
            after = WORD.match(folded, word.end() + 1) if folded[word.end():word.end() + 1] == " " else None
            if after:
                found.add(f"{word[0]} {after[0]}")
            before = LAST_WORD.search(folded, max(0, begin - LONGEST_BEFORE), begin)
            if before:
                found.add(f"{before[1]} {word[0]}")
        return found

    def hits(self, folded: str) -> list[tuple[int, int]]:
        """Place and term of each occurrence outside exception phrases."""
        hits, spans = [], []
        for last, (key, whole, start) in self.automaton.iter(folded):
            begin, end = last - len(key) + 1, last + 1
            if begin and folded[begin - 1].isalnum():
                continue
            if end < len(folded) and folded[end].isalnum():
                whole = -1
            elif key in self.harmless:
                spans.append((begin, end))
            hits += [(begin, end, i) for i in (whole, start) if i >= 0 and (i == whole or end < len(folded) and folded[end].isalnum())]
        # An exception phrase holds a hit if, of the phrases that begin no later, one ends no earlier.
        spans.sort()
        starts = [b for b, _ in spans]
        farthest = list(itertools.accumulate((e for _, e in spans), max))
        out = []
        for begin, end, i in hits:
            before = bisect.bisect_right(starts, begin)
            if not before or farthest[before - 1] < end:
                out.append((begin, i))
        return out


def learned_lexicon(counts: dict[str, tuple[int, int]], clean: int, toxic: int) -> dict[str, float]:
    """Terms and weights from (clean, toxic) document counts of terms, and of all documents. A
    beginning whose toxic documents a chosen longer term explains is left out, and so is a longer
    term that adds nothing to a chosen beginning."""
    weight = {}
    for term, (c0, c1) in counts.items():
        if c1 >= MIN_DOCS:
            odds = np.log((c1 + 0.5) / (toxic - c1 + 0.5)) - np.log((c0 + 0.5) / (clean - c0 + 0.5))
            low = float(odds - np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5)))
            if low >= MIN_ODDS:
                weight[term] = low
    chosen: dict[str, float] = {}
    explained: dict[str, int] = {}
    for term in sorted(weight, key=lambda t: (-weight[t], len(t), t)):
        stem = term.rstrip("*")
        if any(stem[:k] + "*" in chosen for k in STEMS if k < len(stem) or (k == len(stem) and not term.endswith("*"))):
            continue
        if term.endswith("*") and counts[term][1] - explained.get(term, 0) < MIN_DOCS:
            continue
        chosen[term] = weight[term]
        for k in STEMS:
            if k < len(stem):
                above = stem[:k] + "*"
                explained[above] = max(explained.get(above, 0), counts[term][1])
    return chosen


@dataclass
class Toxicity:
    """A lexicon with weights, and the logistic curve over a document's inputs."""

    lexicon: tuple[str, ...] = tuple(LEXICON)
    exceptions: tuple[str, ...] = EXCEPTIONS
    weights: np.ndarray = field(default_factory=lambda: np.full(len(LEXICON), 5.0))
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.5, 0.5]))

    def inputs(self, counts: list[dict[int, int]], n_words: np.ndarray) -> np.ndarray:
        """1, the greatest weight, the sum of weights and the sum by length (both logarithmic)."""
        most = np.array([max((self.weights[i] for i in one), default=0.0) for one in counts], dtype=np.float64)
        total = np.array([sum(self.weights[i] * c for i, c in one.items()) for one in counts], dtype=np.float64)
        return np.stack([np.ones(len(counts)), most, np.log1p(total), np.log1p(100 * total / np.maximum(n_words, 1))], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(x @ self.curve / 2))

    def counted(self, part: pa.RecordBatch) -> tuple[list[dict[int, int]], np.ndarray]:
        """Counts of the terms and inputs of each text of a batch."""
        matcher = Matcher.get(self.lexicon, self.exceptions)
        counts = [matcher.count(fold(t)) if t else {} for t in part.column("text").to_pylist()]
        return counts, self.inputs(counts, Texts(part.column("text")).n_words)

    def fit_curve(self, x: np.ndarray, y: np.ndarray) -> None:
        curve = np.zeros(x.shape[1])
        for _ in range(60):   # Newton steps; a ridge keeps separable labels finite
            p = 0.5 * (1 + np.tanh(x @ curve / 2))
            slope = x.T @ (p - y) + 0.1 * curve
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(curve)), slope)
            curve = curve - step / max(1.0, np.abs(step).max() / 2)
        self.curve = curve


def _counted(keys_of):
    """Documents of each (model, key), clean and toxic ones, summed within a task. ``keys_of(folded,
    half)`` gives the pairs of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bool, Counter[tuple[int, str]]] = {False: Counter(), True: Counter()}
        for part in chunks(batches):
            for text, toxic, half in zip(*[part.column(c).to_pylist() for c in ("text", "toxic", "half")], strict=True):
                total[toxic].update(keys_of(fold(text), half))
        keys = list(total[False] | total[True])
        yield pa.RecordBatch.from_arrays(
            [pa.array([m for m, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.string()),
             pa.array([total[False][k] for k in keys], pa.int64()), pa.array([total[True][k] for k in keys], pa.int64())],
            ["model", "key", "clean", "toxic"])
    return run


def _documents_of(known: DataFrame, keys_of, kept: Column) -> list[dict[str, tuple[int, int]]]:
    """For each model its keys with their clean and toxic documents, as far as ``kept`` holds."""
    rows = (known.mapInArrow(_counted(keys_of), "model int, key string, clean long, toxic long")
            .groupBy("model", "key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(kept).collect())   # terms of the sample
    out: list[dict[str, tuple[int, int]]] = [{}, {}, {}]
    for r in rows:
        out[r.model][r.key] = (r.clean, r.toxic)
    return out


def _with_lexicon(counts: dict[str, tuple[int, int]], clean: int, toxic: int) -> Toxicity | None:
    """The model of these counts of terms; None where no term is surely toxic."""
    weights = learned_lexicon({t: c for t, c in counts.items() if c[1] >= MIN_DOCS}, clean, toxic)
    if not weights:
        return None
    usual = 0.5 * float(np.median(list(weights.values())))
    weights |= {t: usual for t in sorted(set(LEXICON) - counts.keys())}
    return Toxicity(tuple(weights), weights=np.array(list(weights.values())))


def learned_exceptions(counts: dict[str, tuple[int, int]], clean: int, toxic: int) -> tuple[str, ...]:
    """Of phrases with their (clean, toxic) documents those whose documents, ``MIN_DOCS`` clean ones
    at least, are toxic no more often than all are."""
    return tuple(sorted(p for p, (c0, c1) in counts.items() if c0 >= MIN_DOCS and c1 * clean <= c0 * toxic))


def learn(docs: DataFrame, labels: DataFrame, train: Column | None = None,
          sample_rows: int = lab.SAMPLE_ROWS) -> Toxicity:
    """Lexicon, exceptions and curve from ``sample_rows`` labelled documents at most, of those rows
    of ``labels`` for which ``train`` holds. Without both labels: the fixed lexicon, equal weights.
    A half of the sample that makes no lexicon lends the whole sample's."""
    common.prepare(docs.sparkSession)
    chosen = lab.sample(labels, "toxic", sample_rows, train)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int").alias("half")
    known = common.saved(common.documents(docs).join(F.broadcast(chosen), "doc_id")
                         .select("text", (F.col("label") == 1).alias("toxic"), half), "toxic")
    size = {(r.half, r.toxic): r["count"] for r in known.groupBy("half", "toxic").count().collect()}
    rows = [(size.get((h, False), 0), size.get((h, True), 0)) for h in (0, 1)]
    rows.append((rows[0][0] + rows[1][0], rows[0][1] + rows[1][1]))   # the third model: both halves
    if 0 in rows[2]:
        return Toxicity()

    def terms(only: frozenset[str] | None):
        def of(folded: str, half: int) -> list[tuple[int, str]]:
            found = terms_of(folded)
            return [(m, t) for t in (found if only is None else found & only) for m in (half, 2)]
        return of

    # Few documents are toxic; of the others only the terms of these, and fixed ones, are counted.
    in_toxic = _documents_of(known.where("toxic"), terms(None), (F.col("toxic") >= MIN_DOCS) | F.col("key").isin(LEXICON))
    in_clean = _documents_of(known.where("NOT toxic"), terms(frozenset(LEXICON).union(*in_toxic)), F.lit(True))
    counts = [{t: (c.get(t, (0, 0))[0], n.get(t, (0, 0))[1]) for t in c.keys() | n.keys()}
              for c, n in zip(in_clean, in_toxic, strict=True)]
    whole = _with_lexicon(counts[2], *rows[2]) or Toxicity()
    models = [*[_with_lexicon(counts[h], *rows[h]) for h in (0, 1)], whole]

    def phrases(folded: str, half: int) -> list[tuple[int, str]]:
        return [(m, p) for m in (half, 2) if models[m]
                for p in Matcher.get(models[m].lexicon, models[m].exceptions).phrases(folded)]

    pairs = _documents_of(known, phrases, F.col("clean") >= MIN_DOCS)
    for model, found, of in zip(models, pairs, rows, strict=True):
        if model:
            model.exceptions = tuple(sorted({*EXCEPTIONS, *learned_exceptions(found, *of)}))
    others = [models[1] or whole, models[0] or whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            of = part.column("half").to_numpy()
            for h in (0, 1):
                rows = part.filter(pa.array(of == h))
                if rows.num_rows:
                    x = others[h].counted(rows)[1]
                    yield pa.RecordBatch.from_arrays([rows.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))],
                                                     ["toxic", "x"])

    seen = known.mapInArrow(run, "toxic boolean, x array<double>").toPandas()
    x, y = np.stack(seen["x"].to_numpy()), seen["toxic"].to_numpy().astype(np.float64)
    order = np.lexsort(np.column_stack((x, y)).T)   # the same curve whatever the order of arrival
    whole.fit_curve(x[order], y[order])
    return whole


def scored(docs: DataFrame, labels: DataFrame, train: Column | None = None,
           sample_rows: int = lab.SAMPLE_ROWS) -> DataFrame:
    """doc_id, score (0 to 1), n_terms (matches that count) of every row of ``docs``.

    Nulls: a null text is an empty one, with the score of a text without terms; a null doc_id stays
    null and is never a labelled row. Repeated rows and ties get equal scores, row by row. Empty
    documents: no rows. Labels that are empty or of one kind: the fixed lexicon, equal weights.
    Other columns are ignored. Texts of any length are taken whole.
    """
    model = learn(docs, labels, train, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            counts, x = model.counted(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(model.probability(x)),
                 pa.array([sum(one.values()) for one in counts], pa.int64())], ["doc_id", "score", "n_terms"])

    return common.documents(docs).mapInArrow(run, "doc_id long, score double, n_terms long")


def held_out() -> Column:
    return lab.fold(5) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"), ~held_out())
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_terms")
