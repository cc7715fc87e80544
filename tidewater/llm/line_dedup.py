"""Fuzzy duplicates among the lines of all documents, in DataFrame operations only.

Lines are compared by their sets of SHINGLE-byte windows (UTF-8).  MinHash values
of each distinct line form BANDS keys of ROWS values; lines that share a key meet
in a bucket.  In a bucket every line is first compared with the smallest one and
with its neighbour in the order of the next band's key; the exact Jaccard
similarity of the shingle sets decides and distributed union-find joins what is
linked.  In buckets that then still hold several components, every line outside
the largest one is compared with all lines of other components whose size allows a
link, block by block; groups of shingles whose numbers are odd in one set and even in
the other are counted first, since two sets differ in at least as many.  Links inside a component would change nothing, so no pair
of a bucket that could join two components is left untested.  The first line of
each component, by doc_id and line number, is kept.

Each MinHash value is a minimum over all shingles of the whole line; the hash
functions are linear maps of a shingle's hash with their own random constants.

Every line but blank ones is compared.  A line of fewer than SHINGLE bytes has no
window; it is one shingle as a whole, so it is like equal lines only and needs no
bands.  Equal lines are recognised by a 64-bit hash.  A null text has no lines.  Rows with the same doc_id and text share their
lines' fate; rows without doc_id come first.  An empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewater.llm.graphs import components, extended
from tidewater.llm.storage import packed, sent, settled, staged

SHINGLE = 8
SIMILARITY = 0.8
BANDS, ROWS = 8, 4
LEAST = 1  # bytes; blank lines alone are left out
IDS_TO_SEND = 2_000_000  # 16 MB of line hashes
PAIRS_A_TASK = 2_000  # verified by a task
PIECE = 248  # shingles of a piece of a line
PLACES = 16  # shingles whose hashes are one row
PARITY = 32  # words of 64 groups of shingles
BLOCK = 500  # lines of a bucket on each side of a cell whose pairs one task compares

_BITS = (1 << 31) - 1  # of a shingle's hash and of a MinHash value
_DRAWN = random.Random(2)
#: An odd factor and a summand for each hash function; products keep their lowest 31 bits.
_MAPS = [(_DRAWN.getrandbits(31) | 1, _DRAWN.getrandbits(31)) for _ in range(BANDS * ROWS)]



def _line_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`doc_id, version, line_no, line`: every line that is not blank; `version` tells texts of one doc_id apart."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.split(F.col(text), "\n").alias("lines"))
    lines = named.select("doc_id", "version", F.posexplode("lines").alias("line_no", "line"))
    return lines.where((F.octet_length("line") >= LEAST) & F.col("line").rlike(r"\S"))


def _shingle(raw: Column, at: Column) -> Column:
    return F.substring(raw, at, F.lit(SHINGLE))


def _shingle_hashes(line: Column) -> Column:
    """Hashes of all shingles of a line; the list of one element hands its bytes on once, not for every place."""
    places = lambda raw: F.sequence(F.lit(1), F.octet_length(raw) - (SHINGLE - 1))
    return F.flatten(F.transform(F.array(line.cast("binary")), lambda raw: F.transform(places(raw), lambda at: F.xxhash64(_shingle(raw, at)))))


@contextmanager
def wrapping(spark: SparkSession) -> Iterator[None]:
    """Integer sums and products of the columns made inside wrap around and are not checked, whatever the session says."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _int(bits: int) -> Column:
    """The 32-bit integer of these bits; the lowest 31 bits of sums and products are the same as of larger ones."""
    return F.lit(bits - (1 << 32) if bits >> 31 else bits)


def signatures(lines: DataFrame) -> DataFrame:
    """`line_hash` and BANDS * ROWS MinHash values of every distinct line that has a shingle.

    A line is cut into pieces that share SHINGLE - 1 bytes, so that its bytes are
    not copied for each place; a row below holds the hashes of PLACES shingles.
    """
    starts = lambda raw: F.sequence(F.lit(0), F.octet_length(raw) - SHINGLE, F.lit(PIECE))
    cut = lambda raw: F.transform(starts(raw), lambda at: F.substring(raw, at + 1, F.lit(PIECE + SHINGLE - 1)))
    held = lines.where(F.octet_length("line") >= SHINGLE).select(F.xxhash64("line").alias("line_hash"), F.flatten(F.transform(F.array(F.col("line").cast("binary")), cut)).alias("raws"))
    pieces = held.select("line_hash", F.explode("raws").alias("raw"))
    last = F.octet_length("raw") - (SHINGLE - 1)
    spread = pieces.select("line_hash", "raw", F.explode(F.sequence(F.lit(1), last, F.lit(PLACES))).alias("at"))
    hashed = lambda k: F.hash(_shingle(F.col("raw"), F.least(F.col("at") + k, last)))
    h = spread.select("line_hash", *[hashed(k).alias(f"h{k}") for k in range(PLACES)])
    value = lambda k, factor, summand: (F.col(f"h{k}") * _int(factor) + _int(summand)).bitwiseAND(F.lit(_BITS))
    values = [F.min(F.least(*[value(k, *m) for k in range(PLACES)])).cast("bigint") for m in _MAPS]
    with wrapping(lines.sparkSession):
        return h.groupBy("line_hash").agg(*[v.alias(f"m{k}") for k, v in enumerate(values)])


def buckets(sketched: DataFrame) -> DataFrame:
    """`key, next, band, line_hash, low`: the members of every bucket of more than one line, its smallest line and 32 bits of the key of its next band.

    The signatures are read once: both uses of the dealt bands share one exchange,
    which takes next and band as one number.
    """
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{b + BANDS * r}") for r in range(ROWS)]) for b in range(BANDS)]
    after = lambda b: F.shiftleft(F.shiftrightunsigned(keys[(b + 1) % BANDS], 32), 8).bitwiseOR(F.lit(b).cast("bigint"))
    bands = F.array(*[F.struct(k.alias("key"), after(b).alias("after")) for b, k in enumerate(keys)])
    banded = sketched.select("line_hash", F.explode(bands).alias("at")).select("line_hash", "at.key", "at.after").repartition("key")
    shared = banded.groupBy("key").agg(F.min("line_hash").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    split = [F.shiftrightunsigned("after", 8).alias("next"), F.col("after").bitwiseAND(255).cast("int").alias("band")]
    return staged(banded.join(shared.hint("shuffle_hash"), "key").select("key", *split, "line_hash", "low"), "buckets")


def candidate_pairs(members: DataFrame) -> DataFrame:
    """`a, b`: pairs of distinct lines to verify first, at most two per line and band."""
    order = Window.partitionBy("key").orderBy("next", "line_hash")
    met = members.withColumn("near", F.lag("line_hash").over(order))
    pairs = met.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("line_hash").alias("b")), F.struct(F.col("near").alias("a"), F.col("line_hash").alias("b")))).alias("p"))
    named = pairs.where("p.a <> p.b").select(F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b"))
    return named.distinct()


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """`line_hash, line` of the wanted lines, each once."""
    few = F.broadcast(ids) if ids.count() <= IDS_TO_SEND else ids
    wanted = lines.select(F.xxhash64("line").alias("line_hash"), "line").join(few, "line_hash", "left_semi")
    return wanted.groupBy("line_hash").agg(F.first("line").alias("line"))


def similar_lines(lines: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose exact Jaccard similarity reaches the threshold."""
    n = pairs.count()
    ids = staged(packed(pairs.select(F.explode(F.array("a", "b")).alias("line_hash")).distinct(), 2 * n), "candidates")
    texts = staged(_texts(lines, ids), "lines")
    left = texts.select(F.col("line_hash").alias("a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("line_hash").alias("b"), F.col("line").alias("line_b"))
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PAIRS_A_TASK))
    met = left.join(sent(pairs, n), "a").join(right, "b").select("a", "b", "line_a", "line_b").repartition(parts, "b")
    both = F.struct(_shingle_hashes(F.col("line_a")).alias("left"), _shingle_hashes(F.col("line_b")).alias("right"))
    # behind a generator both lists are made once, and the test stays behind the exchange that spreads the pairs
    listed = met.select("a", "b", F.explode(F.array(both)).alias("s"))
    shared, either = F.size(F.array_intersect("s.left", "s.right")), F.size(F.array_union("s.left", "s.right"))
    return listed.where(shared >= similarity * either).select("a", "b")


def _parities(texts: DataFrame) -> DataFrame:
    """`line_hash, n, odd`: the size of a line's set, and a bit for each group of its shingles: whether their number is odd."""
    each = texts.select("line_hash", F.explode(F.array_distinct(_shingle_hashes(F.col("line")))).alias("x"))
    word, bit = F.shiftrightunsigned("x", 56) % PARITY, F.expr("shiftleft(1L, cast(x & 63 as int))")
    bits = [F.coalesce(F.bit_xor(F.when(word == w, bit)), F.lit(0).cast("bigint")) for w in range(PARITY)]
    return each.groupBy("line_hash").agg(F.count(F.lit(1)).alias("n"), F.array(*bits).alias("odd"))


def missing_links(lines: DataFrame, members: DataFrame, roots: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """`a, b`: links between different components of a bucket.

    Every line outside a bucket's largest component meets all lines of other
    components, but for those that an earlier band has brought together.  Both
    sides are cut into blocks, so a large bucket is dealt out in cells.  Pairs meet
    with their parities alone; the texts of those that may be linked follow.
    """
    named, rows = roots.select(F.col("node").alias("line_hash"), "root"), members.count()
    placed = members.join(sent(named, roots.count()), "line_hash", "left").select("key", "band", "line_hash", F.coalesce("root", "line_hash").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots")).where("roots > 1 and n > 2")
    cut = split.select("key", F.col("main.root").alias("main"), F.ceil(F.col("n") / block).cast("int").alias("ys"), F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("xs"))
    mixed = staged(placed.join(sent(packed(cut, rows), rows), "key"), "mixed")

    ids = mixed.select("line_hash").distinct()
    sketched = _parities(_texts(lines, staged(ids, "candidates")))
    # the buckets of a line, by band: a pair is compared in the first that both are in
    met = mixed.groupBy("line_hash").agg(F.collect_list(F.struct("band", "key")).alias("met"))
    known = staged(sketched.join(met, "line_hash"), "sketched")
    full = mixed.join(known, "line_hash")
    hashed = lambda cells: F.pmod(F.xxhash64("line_hash"), F.col(cells)).cast("int")
    every = lambda cells: F.explode(F.sequence(F.lit(0), F.col(cells) - 1))
    side = lambda table, tag: table.select("key", "x", "y", F.col("band").alias(f"band_{tag}"), F.col("line_hash").alias(f"line_{tag}"), F.col("root").alias(f"root_{tag}"), F.col("n").alias(f"n_{tag}"), F.col("met").alias(f"met_{tag}"), (F.col("root") == F.col("main")).alias(f"main_{tag}"), F.col("odd").alias(f"odd_{tag}"))
    left = side(full.where("root <> main").withColumn("x", hashed("xs")).withColumn("y", every("ys")), "a")
    right = side(full.withColumn("y", hashed("ys")).withColumn("x", every("xs")), "b")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    unlike = F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    first = F.array_min(F.transform(F.array_intersect("met_a", "met_b"), lambda m: m["band"]))
    tests = (
        (F.col("root_a") != F.col("root_b"))
        & (F.col("main_b") | (F.col("line_a") < F.col("line_b")))
        & (F.least(n_a, n_b) >= similarity * F.greatest(n_a, n_b))
        & ((1 + similarity) * unlike <= (1 - similarity) * (n_a + n_b) + 1e-6)
        & (first == F.col("band_a"))
    )
    near = left.join(right.hint("merge"), ["key", "x", "y"]).where(tests)
    pairs = near.select(F.least("line_a", "line_b").alias("a"), F.greatest("line_a", "line_b").alias("b")).distinct()
    return similar_lines(lines, staged(pairs, "pairs"), similarity)


def linked_lines(lines: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """`node, root` of every distinct line that is linked to a smaller one, as in `components`."""
    members = buckets(signatures(lines))
    pairs = staged(candidate_pairs(members), "pairs")
    links = staged(similar_lines(lines, pairs, similarity), "links")
    roots = components(links)
    rest = staged(missing_links(lines, members, roots, similarity, block), "links")
    return roots if rest.isEmpty() else extended(roots, rest)


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """`doc_id, version, line_no, first_doc, first_line, copies, kept` of every line that is not blank.

    `first_doc, first_line` name the line that its component keeps, `copies` counts
    the component's lines.
    """
    lines = _line_rows(docs, doc_id, text)
    roots = linked_lines(lines, similarity)
    named = lines.select("doc_id", "version", "line_no", F.xxhash64("line").alias("line_hash"))
    placed = named.join(sent(roots, roots.count()), named["line_hash"] == roots["node"], "left")
    classed = staged(placed.select("doc_id", "version", "line_no", F.coalesce("root", "line_hash").alias("class")), "classes")
    first = F.min(F.struct("doc_id", "line_no", "version"))
    # a line alone in its class is its own first one, so only the heads of the others are looked up
    heads = staged(classed.groupBy("class").agg(first.alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "heads")
    me = F.struct("doc_id", "line_no", "version")
    headed = classed.join(sent(heads, heads.count()), "class", "left").withColumns({"first": F.coalesce("first", me), "copies": F.coalesce("copies", F.lit(1).cast("bigint"))})
    return headed.select(
        "doc_id", "version", "line_no", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_line"), "copies", me.eqNullSafe(F.col("first")).alias("kept")
    )


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without their repeated lines, other columns as they are; a document that loses all its words goes.

    A document without words to begin with stays.
    """

    def dropped() -> DataFrame:
        gone = line_classes(docs, doc_id, text, similarity).where(~F.col("kept"))
        return gone.groupBy(F.col("doc_id").alias("__doc"), F.col("version").alias("__version")).agg(F.collect_set("line_no").alias("__gone"))

    drops = settled(dropped, "drops")
    at = F.col(doc_id).eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__version"))
    lines = F.split(F.col(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    shorter = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    met = docs.join(drops, at, "left")
    new = met.withColumn("__new", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(shorter))
    kept = new.where(F.col("__gone").isNull() | F.col("__new").rlike(r"\S"))
    return kept.select(*[F.col("__new").alias(c) if c == text else F.col(c) for c in docs.columns])
