"""Conversation structure repair by a persistent audit DP.

A conversation is edited at least cost until the initials of its roles read ``(s?(ua)+)?``. A row
is kept (K, 0; not if blank or a duplicate), given role user or assistant (R, 2; not if blank or a
duplicate) or deleted (D, 3); an empty user or assistant row may be inserted anywhere (I, 2). A
truncated row that is not deleted adds 1. The audit is the string of the edits' letters, in order;
of several cheapest audits the ASCII-least counts.

The DP goes over the rows with four states (nothing yet, system, user, assistant last). The prefix
of edits that leads to a state is one linked node (parent, letter), so that prefixes are shared and
nothing is copied. A node also has its depth, a rolling hash of its whole prefix and its ancestors
at powers of two. Two prefixes of equal cost are compared by a search for their longest common
prefix: the deeper one is lifted to the depth of the other, then both are lifted over ancestors
whose hashes differ. The prefix found is verified: it ends at one shared node, or its letters are
compared one by one (a hash collision is then seen, and the letters decide). The least prefix per
state is enough: two prefixes of one state and cost hold a letter per row besides insertions, so
neither is a beginning of the other, and whatever follows cannot change their order.

On Spark: rows without their texts (flags and a SHA-256 of the text) are dealt by ranges of
(conversation, turn), so that a conversation with very many rows lies in many tasks. Every task
turns runs of at most ``block_rows`` rows of a conversation into a table (first state, last state)
-> (cost, audit). Tables of consecutive blocks compose the same way; ``FAN`` of them are composed
at a time, in rounds, until one is left. Only then rows with texts are streamed, in order, past the
audit of their conversation; SHA-256 is sequential, and its state is all that this last step holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linfold.llm import common

BLOCK_ROWS = 2048
FAN = 16
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
MODULUS, RADIX = (1 << 61) - 1, 1_000_003
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN = (USER, USER, ASSISTANT, USER)   # the state after a row of the role that may come next
CACHE_BLOCKS = 50_000                  # blocks of equal shape solved once per worker; speed only
CACHED_ROWS = 32


class Edits:
    """Edit prefixes as linked nodes; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        up, at, k = [parent], parent, 0
        while k < len(self.up[at]):
            at = self.up[at][k]
            up.append(at)
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * RADIX + ord(letter)) % MODULUS)
        self.up.append(up)
        return node

    def lift(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        rest, k = self.depth[node] - depth, 0
        while rest:
            if rest & 1:
                node = self.up[node][k]
            rest, k = rest >> 1, k + 1
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _same(self, a: int, b: int) -> bool:
        """Whether two prefixes of equal depth and hash are equal, letter by letter up to a shared node."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether prefix ``a`` and letter ``x`` come before prefix ``b`` and letter ``y``."""
        if a == b:
            return x < y
        depth = min(self.depth[a], self.depth[b])
        p, q = self.lift(a, depth), self.lift(b, depth)
        if self.hash[p] != self.hash[q]:
            for k in range(len(self.up[p]) - 1, -1, -1):
                if k < len(self.up[p]) and self.hash[self.up[p][k]] != self.hash[self.up[q][k]]:
                    p, q = self.up[p][k], self.up[q][k]
            if not self._same(self.up[p][0], self.up[q][0]):
                return self.text(a) + x < self.text(b) + y
            return self.letter[p] < self.letter[q]
        if not self._same(p, q):
            return self.text(a) + x < self.text(b) + y
        rest_a, rest_b = self.text_below(a, depth) + x, self.text_below(b, depth) + y
        return rest_a < rest_b

    def text_below(self, node: int, depth: int) -> str:
        """The letters of ``node`` after its first ``depth``."""
        out = []
        while self.depth[node] > depth:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _offer(edits: Edits, best: list, state: int, cost: int, parent: int, letter: str) -> None:
    held = best[state]
    if held is None or cost < held[0] or (cost == held[0] and edits.less(parent, letter, held[1], held[2])):
        best[state] = (cost, parent, letter)


def _inserted(edits: Edits, nodes: list) -> list:
    """States (cost, node) after any insertions. Two in a row at most: a third repeats a state."""
    out = list(nodes)

    def offer(target: int, sources: tuple[int, ...]) -> None:
        best: list = [None] * 4
        for source in sources:
            if out[source] is not None:
                _offer(edits, best, target, out[source][0] + INSERT, out[source][1], "I")
        new, held = best[target], out[target]
        if new is None or (held is not None and held[0] < new[0]):
            return
        if held is not None and held[0] == new[0]:
            # The held prefix has letters, for the empty one costs nothing.
            if not edits.less(new[1], new[2], edits.up[held[1]][0], edits.letter[held[1]]):
                return
        out[target] = (new[0], edits.add(new[1], new[2]))

    offer(USER, (NONE, SYSTEM, ASSISTANT))
    offer(ASSISTANT, (USER,))
    return out


def _block(initials: str, faults: str, starts: tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """(first state, last state) -> (cost, audit) of consecutive rows. ``initials`` has a letter a
    row, ``faults`` too: b blank, d duplicate, t truncated, or a dot."""
    table = {}
    for start in starts:
        edits = Edits()
        nodes: list = [None] * 4
        nodes[start] = (0, 0)
        nodes = _inserted(edits, nodes)
        for initial, fault in zip(initials, faults, strict=True):
            best: list = [None] * 4
            cut = CUT if fault == "t" else 0
            for state, held in enumerate(nodes):
                if held is None:
                    continue
                cost, node = held
                _offer(edits, best, state, cost + DELETE, node, "D")
                if fault in "bd":
                    continue
                kept = NEXT.get((state, initial))
                if kept is not None:
                    _offer(edits, best, kept, cost + KEEP + cut, node, "K")
                _offer(edits, best, TURN[state], cost + REROLE + cut, node, "R")
            nodes = [None if b is None else (b[0], edits.add(b[1], b[2])) for b in best]
            nodes = _inserted(edits, nodes)
        for end, held in enumerate(nodes):
            if held is not None:
                table[start, end] = (held[0], edits.text(held[1]))
    return table


_cache: dict = {}


def block_table(initials: str, faults: str, starts: tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """``_block``, with short blocks of the same shape solved once per worker."""
    if len(initials) > CACHED_ROWS:
        return _block(initials, faults, starts)
    key = (initials, faults, starts)
    if key not in _cache:
        if len(_cache) >= CACHE_BLOCKS:
            _cache.clear()
        _cache[key] = _block(initials, faults, starts)
    return _cache[key]


def composed(first: dict, second: dict) -> dict[tuple[int, int], tuple[int, str]]:
    """The table of two consecutive blocks."""
    out: dict = {}
    for (a, b), (cost, audit) in first.items():
        for (c, d), (more, rest) in second.items():
            if b != c:
                continue
            held = out.get((a, d))
            if held is None or (cost + more, audit + rest) < held:
                out[a, d] = (cost + more, audit + rest)
    return out


BLOCK_SCHEMA = ("conv_id long, part int, nth long, table array<struct<a:int,b:int,cost:long,audit:string>>, "
                "n_rows long, first_turn long, last_turn long, turns long, first_role string, last_role string, "
                "blank long, duplicate long, truncated long, illegal long")


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _blocks(block_rows: int):
    """Blocks of the rows of one partition (sorted by conversation and place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, rows, nth, fresh = None, [], 0, False
        out: list[dict] = []

        def close() -> None:
            nonlocal rows, nth
            if not rows:
                return
            initials = "".join(_initial(r[1]) for r in rows)
            faults = "".join(r[2] for r in rows)
            # Only what follows earlier rows of its conversation needs the other first states. The
            # first conversation of a partition may have begun in the one before.
            starts = (NONE,) if fresh and nth == 0 else (NONE, SYSTEM, USER, ASSISTANT)
            turns = [r[0] for r in rows if r[0] is not None]
            out.append({
                "conv_id": conv, "part": part, "nth": nth,
                "table": [{"a": a, "b": b, "cost": c, "audit": s}
                          for (a, b), (c, s) in block_table(initials, faults, starts).items()],
                "n_rows": len(rows), "first_turn": turns[0] if turns else None,
                "last_turn": turns[-1] if turns else None,
                "turns": len(set(turns)), "first_role": initials[0], "last_role": initials[-1],
                "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
                "illegal": sum(not _legal(a, b) for a, b in zip(initials, initials[1:], strict=False))})
            rows, nth = [], nth + 1

        started = False
        for batch in batches:
            for c, t, r, f in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "turn", "role", "fault")],
                                  strict=True):
                if not started or c != conv:
                    close()
                    fresh, conv, nth, started = started, c, 0, True
                elif len(rows) >= block_rows:
                    close()
                rows.append((t, r, f))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW_BLOCK)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_BLOCK)

    return run


_TABLE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
ARROW_BLOCK = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("table", _TABLE), ("n_rows", pa.int64()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("first_role", pa.string()),
    ("last_role", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64())])


def _as_table(rows: list[dict]) -> dict:
    return {(r["a"], r["b"]): (r["cost"], r["audit"]) for r in rows}


def _merged(blocks: list[dict]) -> dict:
    """One block from consecutive ones."""
    out, table = dict(blocks[0]), _as_table(blocks[0]["table"])
    for b in blocks[1:]:
        table = composed(table, _as_table(b["table"]))
        if b["first_turn"] is not None:
            out["turns"] += b["turns"] - (out["last_turn"] == b["first_turn"])
            out["last_turn"] = b["last_turn"]
            if out["first_turn"] is None:
                out["first_turn"] = b["first_turn"]
        out["illegal"] += b["illegal"] + (not _legal(out["last_role"], b["first_role"]))
        out["last_role"] = b["last_role"]
        for count in ("n_rows", "blank", "duplicate", "truncated"):
            out[count] += b[count]
    out["table"] = [{"a": a, "b": b, "cost": c, "audit": s} for (a, b), (c, s) in table.items()]
    return out


def _merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a list of blocks: each list in order, composed."""
    for batch in batches:
        for row in range(batch.num_rows):
            blocks = sorted(batch.column("blocks")[row].as_py(), key=lambda b: (b["part"], b["nth"]))
            yield pa.RecordBatch.from_pylist([_merged(blocks)], schema=ARROW_BLOCK)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after the damage of the contract: by
    crc32('conv_id:turn') % 20 a row is dropped (0), emptied (1), loses its ``[.!?]`` (2), is
    repeated (3) or gets role user (4). Nulls count as one space (in role, text and the hashed string)."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    case = F.col("_case")
    return (rows.withColumn("_case", F.crc32(key.cast("binary")) % 20).where(case != 0)
            .select("conv_id", "turn", F.when(case == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(case == 1, "").when(case == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_c"))
            .drop("_c"))


PLACE = ["turn", "role", "digest", "_r"]


def _faulted(rows: DataFrame) -> DataFrame:
    """Rows without their text, with their first fault (b, d, t or a dot). A duplicate has a role
    and text (by SHA-256) of an earlier row of its conversation."""
    visible = r"[^\x20\x09-\x0D]"
    base = rows.select(
        "conv_id", "turn", "role", "_r", F.sha2("text", 256).alias("digest"),
        F.when(~F.col("text").rlike(visible), "b")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise(".").alias("fault"))
    key = ["conv_id", "role", "digest"]
    seen = (base.where("fault <> 'b'").groupBy(*key)
            .agg(F.min(F.struct("turn", "_r")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # A role and text may fill most of a conversation: its rows are dealt over SALT tasks.
    salt = 16
    seen = seen.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                       F.col("first._r").alias("first"), F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("s"))
    dealt = base.withColumn("s", F.pmod(F.xxhash64("_r"), F.lit(salt)).cast("int"))
    match = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
             & (F.col("digest") == F.col("d")) & (dealt["s"] == seen["s"]))
    later = (F.col("first").isNotNull()) & (F.col("fault") != "b") & (F.col("first") != F.col("_r"))
    return (dealt.join(seen, match, "left")
            .select("conv_id", "turn", "role", "digest", "_r", F.when(later, "d").otherwise(F.col("fault")).alias("fault")))


def _audits(rows: DataFrame, block_rows: int) -> DataFrame:
    """One block row per conversation."""
    spark = rows.sparkSession
    parts = common.shuffle_partitions(spark)
    faulted = _faulted(rows)
    blocks = common.saved(
        faulted.repartitionByRange(parts, "conv_id", *PLACE).sortWithinPartitions("conv_id", *PLACE)
        .select("conv_id", "turn", "role", "fault").mapInArrow(_blocks(block_rows), BLOCK_SCHEMA), "repair-blocks")
    item = F.struct(*[F.col(c) for c in blocks.columns])
    done = None
    while True:
        # Which conversations are in several blocks; blocks are numbered within them.
        several = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not several.limit(1).collect():
            return blocks if done is None else done.unionByName(blocks)
        key = F.col("conv_id").eqNullSafe(F.col("c"))
        several = several.select(F.col("conv_id").alias("c"))
        single = blocks.join(several, key, "left_anti")
        done = single if done is None else done.unionByName(single)
        order = _numbered(blocks.join(several, key, "left_semi"))
        blocks = common.saved(
            order.groupBy("conv_id", F.floor(F.col("i") / FAN).alias("g")).agg(F.collect_list(item).alias("blocks"))
            .select("blocks").mapInArrow(_merge_lists, BLOCK_SCHEMA), "repair-merged")


def _numbered(blocks: DataFrame) -> DataFrame:
    """``i``: the place of a block within its conversation; one row a block, without the tables."""
    places = blocks.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("nth").alias("k"))
    places = places.withColumn("i", F.row_number().over(Window.partitionBy("c").orderBy("p", "k")) - 1)
    return blocks.join(places, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
                       & (F.col("nth") == F.col("k"))).drop("c", "p", "k")


OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
       "audit string, repaired_sha256 string")
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ROLE = {NONE: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}


class _Repair:
    """The repaired rows of one conversation, fed row by row in order."""

    def __init__(self, head: dict):
        self.head, self.at, self.state = head, 0, NONE
        self.digest, self.any = hashlib.sha256(), False

    def put(self, role: str, text: str) -> None:
        if self.any:
            self.digest.update(b"\n")
        self.any = True
        self.digest.update(role.encode())
        self.digest.update(b":")
        self.digest.update(text.encode())

    def inserts(self) -> None:
        audit = self.head["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            self.put(_ROLE[self.state], "")
            self.state = TURN[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.head["audit"][self.at]
        self.at += 1
        if letter == "K":
            self.put(role, text)
            self.state = NEXT[self.state, role[:1]]
        elif letter == "R":
            self.put(_ROLE[self.state], text)
            self.state = TURN[self.state]

    def result(self) -> dict:
        self.inserts()
        return {**self.head, "repaired_sha256": self.digest.hexdigest()}


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, a head first: its audit, then its rows in order."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])
    now, out = None, []
    names = ["head", "conv_id", *COUNTS, "audit", "role", "text"]
    for batch in batches:
        step = 4096
        for begin in range(0, batch.num_rows, step):
            piece = batch.slice(begin, step)
            for row in zip(*[piece.column(c).to_pylist() for c in names], strict=True):
                if row[0]:
                    if now is not None:
                        out.append(now.result())
                    now = _Repair(dict(zip(names[1:-2], row[1:-2], strict=True)))
                else:
                    now.row(row[-2], row[-1])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.result()], schema=schema)


def repaired(original: DataFrame, rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every conv_id of ``original``: gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256 of its ``rows`` (conv_id, turn, role, text without nulls but in conv_id and turn).

    Order: by turn (nulls first), then role, then the SHA-256 of the text. Nulls: a null conv_id is
    a conversation of its own; null turns count for order only. Empty texts are blank. Repeated rows
    are duplicates. A role that does not begin with s, u or a (an empty one too) can't be kept.
    A conversation without rows: zeros, an empty audit, the empty string's hash. Empty table: no
    rows. Other columns are ignored, whatever their names. Texts are read whole, one at a time.
    """
    spark = original.sparkSession
    common.prepare(spark)
    rows = common.saved(rows.withColumn("_r", F.monotonically_increasing_id()), "repair-rows")
    audits = _audits(rows, block_rows)
    best = F.expr("array_min(transform(filter(table, x -> x.a = 0 AND x.b IN (0, 3)), "
                  "x -> struct(x.cost AS cost, x.audit AS audit)))")
    results = audits.select("conv_id", best.alias("best"), "turns", "first_turn", "last_turn",
                            "blank", "duplicate", "truncated", "illegal").select(
        F.lit(1).alias("n"), "conv_id",
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"),
        F.col("best.audit").alias("audit"))
    none = original.select(F.lit(0).alias("n"), F.col("conv_id").cast("long").alias("conv_id"),
                           *[F.lit(0).cast("long").alias(c) for c in COUNTS], F.lit("").alias("audit")).distinct()
    heads = (results.unionByName(none).groupBy("conv_id")
             .agg(F.max(F.struct("n", *COUNTS, "audit")).alias("h"))
             .select(F.lit(True).alias("head"), "conv_id", "h.*").drop("n"))
    empty: list[Column] = [F.lit(None).cast(t).alias(c) for c, t in
                           (("turn", "long"), ("role", "string"), ("digest", "string"), ("_r", "long"), ("text", "string"))]
    body = rows.select(F.lit(False).alias("head"), "conv_id", *[F.lit(None).cast("long").alias(c) for c in COUNTS],
                       F.lit(None).cast("string").alias("audit"), "turn", "role",
                       F.sha2("text", 256).alias("digest"), "_r", "text")
    both = heads.select("*", *empty).unionByName(body)
    return (both.repartition(common.shuffle_partitions(spark), "conv_id")
            .sortWithinPartitions("conv_id", F.col("head").desc(), *PLACE)
            .select("head", "conv_id", *COUNTS, "audit", "role", "text").mapInArrow(_digested, OUT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations")
    return repaired(conversations, damaged(conversations))
