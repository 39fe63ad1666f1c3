"""Fuzzy line dedup by MinHash, DataFrame operations only.

A line's shingles are the ``chars`` characters from every character of it; a
shorter line is one shingle.  Signatures are BANDS x ROWS minima over hashed
shingles; lines that agree on a whole band are candidates, the exact Jaccard similarity of
their shingles is computed, and a distributed union-find closes the links into
components, of which the first line stays.

* equal lines are told by a 128-bit hash and need no comparison; only different
  lines are signed, their shingles as rows of RUN combined where they are made;
* beside its bands a line has a bitmap of its shingles (a long line also every
  fourth shingle).  Bits that differ are shingles of one line only, and linked
  lines can have few of these: most candidates fall by that, and no link does;
* bands are compared BANDS_AT_ONCE at a time in a join whose condition holds the
  bitmaps, so candidate pairs are never rows, only pairs that the bitmaps leave;
* first each member meets the one before it in its band.  After the union-find
  over these links only pairs of different components are compared: links inside
  a component cannot change the result.  Nor are members of a band's largest
  component compared with each other;
* the text of a line is fetched only if a pair is left with it.  Of those a line
  meets its others in blocks of bounded size, each line's shingles made once a block;
* scratch tables go when read, and shuffle files with the job that wrote them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gocledger.llm.common import Scratch, null_safe
from gocledger.llm.components import connected_components
from gocledger.session import cut_lineage_observed, remove_path

#: Characters of a shingle.
CHARS = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 3
BLOCK = 256
SEED = 7
#: Shingles of one row while lines are signed.
RUN = 16
#: 64-bit words of a line's bitmap of shingles.
WORDS = 16
#: Lines of more shingles than the bitmap has bits also keep two bytes of each that this divides.
THIN = 4
#: Bands that are shuffled at once: with a line's bitmap they bound the disk.
BANDS_AT_ONCE = 2
#: Parts in which the sketches are written again with their components.
SLICES = 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _chars(line: Column) -> Column:
    """Four bytes for each character, so that a shingle is cut out at its place without counting from the start."""
    return F.encode(line, "UTF-32")


def _last(line: Column, width: int) -> Column:
    """Where the last shingle starts."""
    return F.greatest(F.char_length(line) - width, F.lit(0))


def _starts(line: Column, width: int) -> Column:
    return F.sequence(F.lit(0), _last(line, width))


def _runs(last: Column) -> Column:
    return F.sequence(F.lit(0), last, F.lit(RUN))


def _shingle(chars: Column, start: Column, width: int) -> Column:
    return F.xxhash64(F.substring(chars, start * 4 + 1, F.lit(4 * width)))


def char_shingles(line: Column, width: int = CHARS) -> Column:
    """Distinct 64-bit hashes of the ``width`` characters from every character of the line; a shorter
    line is one shingle."""
    # An array of one, so that the characters are encoded once for the line and not once for each shingle.
    once = F.transform(F.array(_chars(line)), lambda c: F.transform(_starts(line, width), lambda i: _shingle(c, i, width)))
    return F.array_distinct(once[0])


def _masks(n: int, seed: int) -> list[int]:
    """Fixed 64-bit masks: the minimum of hash XOR mask is a min-wise hash of its own for each mask."""
    out, x = [], (seed * 0x9E3779B97F4A7C15 + 1) % (1 << 64)
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        y = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
        out.append(y - (1 << 63))
    return out


def _minima(lines: DataFrame, chars: int, n: int, seed: int) -> DataFrame:
    """(h1, h2, places, m0, m1, ..., w0, w1, ...) of every different line: where shingles start, minima and bitmap.

    RUN shingles are a row until the minima over a line's shingles, which need no shuffle of their
    own; a line's last row is filled up with its last shingle, which no minimum and no bit minds.
    """
    line = F.col("line")
    one = lines.select("h1", "h2", "line").dropDuplicates(["h1", "h2"])
    runs = one.select("h1", "h2", _chars(line).alias("chars"), _last(line, chars).alias("last")).select(
        "h1", "h2", "chars", "last", F.explode(_runs(F.col("last"))).alias("start"))
    hashes = [f"s{i}" for i in range(RUN)]
    each = runs.select("h1", "h2", "last", *[
        _shingle(F.col("chars"), F.least(F.col("start") + i, F.col("last")), chars).alias(s) for i, s in enumerate(hashes)])

    def word(w: int) -> Column:
        return F.bit_or(F.expr(" | ".join(
            f"if(({s} & {64 * (WORDS - 1)}L) = {64 * w}L, shiftleft(1L, cast({s} & 63L as int)), 0L)" for s in hashes)))

    return each.groupBy("h1", "h2").agg(
        (F.max("last") + 1).alias("places"),
        *[F.min(F.least(*[F.col(s).bitwiseXOR(F.lit(m)) for s in hashes])).alias(f"m{i}") for i, m in enumerate(_masks(n, seed))],
        *[word(w).alias(f"w{w}") for w in range(WORDS)])


def _bands(bands: int, rows: int) -> list[Column]:
    return [F.xxhash64(F.lit(b), *[f"m{i}" for i in range(b * rows, (b + 1) * rows)]).alias(f"b{b}") for b in range(bands)]


def _signed(lines: DataFrame, chars: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(h1, h2, b0, b1, ...): the band keys of every different line."""
    return _minima(lines, chars, bands * rows, seed).select("h1", "h2", *_bands(bands, rows))


#: What of a line is compared before its text.
_MARKS = ("places", "thin", *[f"w{w}" for w in range(WORDS)])


def _sketched(lines: DataFrame, chars: int, bands: int, rows: int, seed: int) -> DataFrame:
    """The band keys and marks of every different line: cid, h1, h2, b0, b1, ..., places, thin, w0, w1, ..."""
    low = _minima(lines, chars, bands * rows, seed).select("h1", "h2", "places", *_bands(bands, rows), *_MARKS[2:])
    line = F.col("line")
    long = (lines.where(_last(line, chars) >= 64 * WORDS).select("h1", "h2", "line").dropDuplicates(["h1", "h2"])
            .select("h1", "h2", _chars(line).alias("chars"), _starts(line, chars).alias("starts"))
            .select("h1", "h2", "chars", F.explode("starts").alias("start"))
            .select("h1", "h2", _shingle(F.col("chars"), F.col("start"), chars).alias("s")).where(F.col("s") % THIN == 0)
            .groupBy("h1", "h2").agg(F.collect_set(F.shiftright("s", 48).cast("smallint")).alias("thin")))
    return low.join(long, ["h1", "h2"], "left").withColumn("cid", F.monotonically_increasing_id())


def _may_link(x: str, y: str, similarity: float) -> Column:
    """False for lines that cannot be linked.

    Lines with Jaccard similarity s differ in at most (1 - s) / s times as many shingles as the smaller
    has, and bits (or thinned shingles) that differ come from at least as many shingles.
    """
    most = (1 - similarity) * F.least(f"{x}places", f"{y}places") + 1e-3
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"{x}w{w}").bitwiseXOR(F.col(f"{y}w{w}"))) for w in range(WORDS)])
    a, b = F.col(f"{x}thin"), F.col(f"{y}thin")
    apart = F.size(a) + F.size(b) - 2 * F.size(F.array_intersect(a, b))
    return (similarity * bits <= most) & (a.isNull() | b.isNull() | (similarity * apart <= most))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_key, line_no, line) of every line that is not blank."""
    return (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.split(F.col(text), "\n").alias("all"))
            .select("doc_id", "text_key", F.posexplode("all").alias("line_no", "line"))
            .where(F.col("line").rlike(r"\S")))


def _hashed(lines: DataFrame, seed: int) -> DataFrame:
    return lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(seed), F.col("line"), F.length("line"))})


def _in_bands(sketch: DataFrame, keys: list[str], prefix: str, *more: str) -> DataFrame:
    """A row for each line and band of ``keys``; columns other than band get ``prefix``."""
    return sketch.select(*[F.col(c).alias(prefix + c) for c in ("cid", *_MARKS, *more)],
                         F.explode(F.array_distinct(F.array(*keys))).alias(f"{prefix}band"))


def _neighbours(sketch: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """(a, b): in bands sorted by length, members and the one before them, if they may be linked."""
    here = _in_bands(sketch, keys, "")
    row = F.struct(*[F.col(c).alias(f"p_{c}") for c in ("cid", *_MARKS)])
    before = F.lag(row).over(Window.partitionBy("band").orderBy("places", "cid"))
    return here.withColumn("before", before).where(F.col("before").isNotNull()).select("cid", *_MARKS, "before.*").where(
        _may_link("", "p_", similarity)).select(F.col("cid").alias("a"), F.col("p_cid").alias("b"))


def _across(sketch: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """(a, b): members of a band that may be linked and are not of one group.

    One of the two is outside the band's largest group, so only those seek; a band of one group has none.
    """
    # Both sides read the same columns, renamed, under the same filters, so that one shuffle serves both.
    full = sketch.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in ("group", *_MARKS[2:])]))
    s, o = _in_bands(full, keys, "s_", "group", "members"), _in_bands(full, keys, "o_", "group", "members")
    largest = Window.partitionBy("s_band").orderBy(F.desc("s_members"), "s_group").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    seekers = s.withColumns({"largest": F.first("s_group").over(largest), "most": F.first("s_members").over(largest)}).where(
        F.col("s_group") != F.col("largest"))
    once = ((F.col("o_group") == F.col("largest")) & (F.col("o_members") == F.col("most"))) | (F.col("s_cid") < F.col("o_cid"))
    return seekers.join(o, (F.col("s_band") == F.col("o_band")) & (F.col("s_group") != F.col("o_group")) & once
                        & _may_link("s_", "o_", similarity)).select(F.col("s_cid").alias("a"), F.col("o_cid").alias("b"))


def _texts(docs: DataFrame, lines: DataFrame, ids: DataFrame, pairs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(cid, line) of every line of ``pairs``, from one of its places."""
    nodes = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    place = F.struct("doc_id", "text_key", "line_no")
    wanted = (lines.join(ids.join(nodes, "cid"), ["h1", "h2"]).groupBy("cid").agg(F.min(place).alias("p"))
              .groupBy(F.col("p.doc_id").alias("__id"), F.col("p.text_key").alias("__key"))
              .agg(F.collect_list(F.struct("p.line_no", "cid")).alias("found")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumns(
        {"__id": F.col("doc_id"), "__key": F.xxhash64("text")})
    return (null_safe(texts, wanted, ["__id", "__key"], "inner").select(F.split("text", "\n").alias("all"), "found")
            .select("all", F.inline("found")).select("cid", F.get("all", F.col("line_no")).alias("line")).dropDuplicates(["cid"]))


def _linked(pairs: DataFrame, texts: DataFrame, similarity: float, block: int, shape: Callable[[Column], Column]) -> DataFrame:
    """(a, b) of the pairs whose shingles are similar; b is null where none of a block is."""
    chunks = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    placed = pairs.join(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "a").select(
        "a", "b", F.pmod(F.xxhash64(F.lit(SEED), "b"), chunks).cast("int").alias("chunk"))
    blocks = (placed.join(texts.select(F.col("cid").alias("b"), F.col("line").alias("other")), "b")
              .groupBy("a", "chunk").agg(F.collect_list(F.struct("b", "other")).alias("block"))
              .withColumn("block", F.transform("block", lambda y: F.struct(y["b"].alias("b"), shape(y["other"]).alias("sh")))))
    met = blocks.join(texts.select(F.col("cid").alias("a"), "line"), "a").withColumn("sh", shape(F.col("line"))).drop("line")

    def link(y: Column) -> Column:
        a, b = F.size("sh"), F.size(y["sh"])
        both = F.size(F.array_intersect("sh", y["sh"]))
        return (F.least(a, b) >= F.lit(similarity) * F.greatest(a, b) - 1e-9) & (both >= F.lit(similarity) * (a + b - both) - 1e-9)

    # Rows without a link stay until they are written: a filter would be pushed below the shingles and make them again.
    return met.select("a", F.explode_outer(F.transform(F.filter("block", link), lambda y: y["b"])).alias("b"))


def _with_groups(sketch: DataFrame, path: str, trees: DataFrame, scratch: Scratch) -> DataFrame:
    """``sketch`` with each line's group and its members, written slice by slice in place of the table at ``path``."""
    sizes = trees.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    known = scratch.cut(trees.join(sizes, "component").select(F.col("node").alias("cid"), "component", "members"), "line-groups")
    done = []
    for k in range(SLICES):
        one = sketch.where(F.col("slice") == k).drop("slice").join(known, "cid", "left").withColumns(
            {"group": F.coalesce("component", "cid"), "members": F.coalesce("members", F.lit(1))}).drop("component", "h1", "h2")
        done.append(scratch.cut(one, "line-sketches"))
        remove_path(sketch.sparkSession, f"{path}/slice={k}")
    return reduce(DataFrame.unionByName, done)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files are deleted with the job that wrote them, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def repeated_lines(docs: DataFrame, scratch: Scratch, *, chars: int = CHARS, similarity: float = SIMILARITY,
                   bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, seed: int = SEED, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """(doc_id, text_key, removed): per document the numbers (from 0, sorted) of the lines that go.

    Lines are what line feeds separate.  Of a component of equal and linked lines
    the first stays: smallest doc_id (nulls last), then smallest text hash
    (``text_key``, xxhash64), then earliest.  Blank lines always stay.  Null texts
    have no lines.  Rows equal in doc_id and text count as one document.
    ``chars``: characters of a shingle.
    """
    with _shuffles_go(docs.sparkSession):
        return _repeated(docs, scratch, chars, similarity, bands, rows, block, seed, doc_id, text)


def _repeated(docs: DataFrame, scratch: Scratch, chars: int, similarity: float, bands: int, rows: int, block: int, seed: int,
              doc_id: str, text: str) -> DataFrame:
    def shape(line: Column) -> Column:
        return char_shingles(line, chars)

    keys = [f"b{i}" for i in range(bands)]
    turns = [keys[i:i + BANDS_AT_ONCE] for i in range(0, bands, BANDS_AT_ONCE)]
    hashed = _hashed(_lines(docs, doc_id, text), seed)
    lines = scratch.cut(hashed.drop("line"), "lines")
    mark = scratch.mark()
    sketch, _ = cut_lineage_observed(
        _sketched(hashed, chars, bands, rows, seed).withColumn("slice", F.pmod(F.xxhash64("cid"), F.lit(SLICES)).cast("int")),
        "llm-line-sketches", [F.count(F.lit(1)).alias("n")], scratch.paths, ("slice",))
    path = scratch.paths[-1]
    ids = scratch.cut(sketch.select("cid", "h1", "h2"), "line-ids")

    since = scratch.mark()
    near = scratch.cut(_neighbours(sketch, turns[0], similarity).distinct(), "line-neighbours")
    found = scratch.cut(_texts(docs, lines, ids, near, doc_id, text), "line-texts")
    first = scratch.cut(_linked(near, found, similarity, block, shape), "line-links")
    trees = scratch.cut(connected_components(first, scratch, "line-trees"), "line-groups")
    scratch.drop(since, scratch.mark() - 1)

    since = scratch.mark()
    grouped = _with_groups(sketch, path, trees, scratch)
    left = [scratch.cut(_across(grouped, some, similarity).distinct(), "line-pairs") for some in turns]
    pairs = scratch.cut(reduce(DataFrame.unionByName, left).distinct(), "line-pairs")
    scratch.drop(since, scratch.mark() - 1)
    found = scratch.cut(_texts(docs, lines, ids, pairs, doc_id, text), "line-texts")
    across = scratch.cut(_linked(pairs, found, similarity, block, shape), "line-cross-links")
    joined = connected_components(across.unionByName(trees.select(F.col("node").alias("a"), F.col("component").alias("b"))),
                                  scratch, "line-components")
    root = ids.join(joined.withColumnRenamed("node", "cid"), "cid").select("h1", "h2", F.col("component").alias("root"))
    # Equal lines outside any component form one of their own, named by their hash.
    equal = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("h1", "h2")
    named = (equal.withColumn("root", F.lit(None).cast("long")).unionByName(root).groupBy("h1", "h2").agg(F.max("root").alias("root"))
             .select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("root"),
                     F.when(F.col("root").isNull(), F.col("h1")).otherwise(0).alias("r1"),
                     F.when(F.col("root").isNull(), F.col("h2")).otherwise(0).alias("r2")))
    named = scratch.cut(named.select("__h1", "__h2", F.coalesce("root", F.lit(-1)).alias("root"), "r1", "r2"), "line-roots")
    scratch.drop(mark, scratch.mark() - 1)
    full_place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "line_no")
    places = lines.join(named, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))).select(
        "root", "r1", "r2", "doc_id", "text_key", "line_no")
    kept = places.groupBy("root", "r1", "r2").agg(F.min(full_place).alias("top"), F.max(full_place).alias("end")).where(
        F.col("top") != F.col("end")).select("root", "r1", "r2", "top")
    gone = places.join(kept, ["root", "r1", "r2"]).where(full_place != F.col("top"))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def drop_lines(docs: DataFrame, removed: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of ``text``; documents that lose all lines keep an empty text."""
    names = docs.columns
    marked = docs.withColumns({"__id": F.col(doc_id), "__key": F.xxhash64(F.col(text))})
    gone = removed.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("removed").alias("__gone"))
    met = null_safe(marked, gone, ["__id", "__key"], "left")
    left = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    return met.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(left)).select(*names)


def dedup_lines(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``docs`` with every line but the first of each component removed (see :func:`repeated_lines`)."""
    removed = scratch.cut(repeated_lines(docs, scratch, **options), "removed-lines")
    return drop_lines(docs, removed, doc_id=options.get("doc_id", "doc_id"), text=options.get("text", "text"))
