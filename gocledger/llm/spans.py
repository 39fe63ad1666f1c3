"""Substring dedup by sliding sentence spans.

Every run of ``span`` consecutive sentences of a document is hashed (128 bits of
its words); a global aggregation finds the first place of every span that occurs
more than once, and the sentences covered by any other place of it are removed.

Sentences end at line ends, behind ``.``, ``!`` or ``?``, any marks and white
space, and behind the stops of scripts that leave no blank after them.  Words are
runs of letters and digits; in scripts written without blanks (Chinese, Japanese,
Thai and their like) every character is one.  A sentence is held in pieces: from
its 9th word on it is cut behind every word whose checksum is a multiple of four.
The cut depends on that word and the few before it, so two copies of a passage in
the midst of long sentences are cut alike.

Two passes of runs are hashed: every run of ``span`` whole sentences, and every
run of ``span`` pieces (the same where no sentence is long).  A run of fewer than
``min_words`` words is lengthened by what follows, so that headings and one-word
sentences do not make spans that repeat by chance; the last run reaches back as
far as it must, so that no tail is without one; and a text of fewer sentences or
words than a run is one run as a whole.  A text that repeats itself (``x. x. x.``
without end) loses its own later repetitions like any other: that is meant.

Every task combines its own spans before the shuffle: a place that is not the
task's first place of its span is no first place at all, so it is decided there
and then, and only one place of a span leaves a batch.  A span that stands in a
third of all documents thus meets in one task as one row per batch.  One shuffle
brings the places of a span together in order; decided places ride along, spread
evenly.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import null_safe, utf8, without

SPAN = 3
MIN_WORDS = 12
#: Words of a sentence before it may be cut inside, and how rare the cutting words are.
LONG_WORDS = 8
CUT_EVERY = 4
ADDED = ("n_sentences", "n_removed")

#: Documents whose spans or cut texts are held at once.
_ROWS = 2048

#: Stops that need no blank behind them: 。 ！ ？ ． ｡ । ؟ ۔
_STOPS = rb"\xe3\x80\x82|\xef\xbc[\x81\x9f\x8e]|\xef\xbd\xa1|\xe0\xa5\xa4|\xd8\x9f|\xdb\x94"
#: One character of a script without blanks: Thai, Lao, Burmese, Khmer, kana, Han.
_UNSPACED = (rb"\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xe3[\x81-\xbf][\x80-\xbf]"
             rb"|[\xe4-\xe9][\x80-\xbf]{2}|\xf0[\xa0-\xbf][\x80-\xbf]{2}")
_END = re.compile(rb"[.!?][^0-9a-z\x80-\xff\s]*\s+|(?:" + _STOPS + rb")+\s*|[\r\n]\s*")
_WORD = re.compile(_UNSPACED + rb"|(?:[0-9a-z]+|(?!" + _STOPS + rb"|" + _UNSPACED + rb"|\xe3\x80|\xef[\xbc\xbd])"
                   rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}))+")
#: Lead bytes without which none of the above can occur: then two plain patterns find the same.
_SPECIAL = re.compile(rb"[\xd8\xdb\xe0\xe1\xe3-\xe9\xef\xf0]")
_PLAIN_END = re.compile(rb"[.!?][^0-9a-z\x80-\xff\s]*\s+|[\r\n]\s*")
_PLAIN_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _patterns(data: bytes) -> tuple[re.Pattern[bytes], re.Pattern[bytes]]:
    """What ends a sentence, and what a word is, for this text."""
    return (_END, _WORD) if _SPECIAL.search(data) else (_PLAIN_END, _PLAIN_WORD)


def sentence_bounds(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the pieces of a text; a range ends where the next begins, so that
    their concatenation is the text."""
    end, word = _patterns(data)
    cuts = [0, *(m.end() for m in end.finditer(data)), len(data)]
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a > 2 * LONG_WORDS:
            for m in islice(word.finditer(data, a, b), LONG_WORDS, None):
                if crc32(m[0]) % CUT_EVERY == 0:
                    out.append((a, m.end()))
                    a = m.end()
        if b > a:
            out.append((a, b))
    return out


def sentence_words(data: bytes) -> tuple[list[list[bytes]], list[int]]:
    """The words of every range of :func:`sentence_bounds`, without looking for the ranges' places;
    and the number of the first piece of every sentence."""
    out: list[list[bytes]] = []
    begins: list[int] = []
    end, word = _patterns(data)
    segments = end.split(data)
    for i, seg in enumerate(segments):
        last = i == len(segments) - 1
        words = word.findall(seg)
        begins.append(len(out))
        if len(words) > LONG_WORDS and len(seg) + (not last) > 2 * LONG_WORDS:
            at = 0
            for j in range(LONG_WORDS, len(words)):
                if crc32(words[j]) % CUT_EVERY == 0:
                    out.append(words[at:j + 1])
                    at = j + 1
            if at < len(words) or not last or not seg.endswith(words[-1]):
                out.append(words[at:])
        elif seg or not last:
            out.append(words)
    return out, begins


def span_ranges(sizes: list[int], span: int, min_words: int) -> list[tuple[int, int]]:
    """(first, how many) of every sliding run: ``span`` sentences with words, lengthened to
    ``min_words`` words; the last one reaches back instead.  A text too short for any is one
    run.  ``sizes``: words of each sentence."""
    full = [i for i, n in enumerate(sizes) if n]
    if not full:
        return []
    upto = [0, *accumulate(sizes[i] for i in full)]
    out = []
    b = 0
    for a in range(len(full)):
        b = max(a + span, b)
        while b < len(upto) and upto[b] < upto[a] + min_words:
            b += 1
        if b > len(full):
            break
        out.append((a, b))
    if not out:
        out.append((0, len(full)))
    elif out[-1][1] < len(full):
        a = max(0, len(full) - span)
        while upto[-1] - upto[a] < min_words:
            a -= 1
        out.append((a, len(full)))
    return [(full[a], full[b - 1] - full[a] + 1) for a, b in out]


def text_spans(text: str | None, span: int, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(first piece, pieces, 128-bit hash) of every span of a whole text.

    The hash covers the words (letters and digits, lower case), not the marks between them.
    """
    words, begins = sentence_words(utf8(text))
    joined = [b" ".join(w) for w in words]
    sizes = [len(w) for w in words]
    runs = span_ranges(sizes, span, min_words)
    if len(begins) < len(words):
        # A sentence's last piece may hold no word; no run ends with such a one.
        ends = [b - (b - a > 1 and not sizes[b - 1]) for a, b in zip(begins, [*begins[1:], len(words)])]
        whole = span_ranges([sum(sizes[a:b]) for a, b in zip(begins, ends)], span, min_words)
        known = set(runs)
        runs += [r for a, n in whole if (r := (begins[a], ends[a + n - 1] - begins[a])) not in known]
    for first, n in runs:
        yield first, n, xxhash.xxh3_128_digest(b" ".join([w for w in joined[first:first + n] if w]))


#: A place in a text as one number, in order: first piece, pieces, and whether it is known to be no first place.
_FIRST, _LATE = 33, 1


def _places(span: int, min_words: int):
    """mapInArrow function: (h1, h2, doc_id, text_key, place) of the spans of a batch.  Places that are
    already known not to be the first of their span are marked late; their h1 only spreads them evenly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, _ROWS) for b in batches for a in range(0, len(b), _ROWS)):
            col = batch.schema.get_field_index
            texts, ids = batch.column(col("text")), batch.column(col("doc_id"))
            row, first, size, digest = array("q"), array("q"), array("q"), bytearray()
            for i in range(len(batch)):
                for a, k, h in text_spans(texts[i].as_py(), span, min_words):
                    row.append(i)
                    first.append(a)
                    size.append(k)
                    digest += h
            if not row:
                continue
            at, place = np.array(row), (np.array(first) << _FIRST) | (np.array(size) << 1)
            h1, h2 = np.frombuffer(bytes(digest), dtype="<i8").reshape(-1, 2).T
            doc = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()[at].astype(np.int64)
            key = batch.column(col("text_key")).to_numpy(zero_copy_only=False)[at]
            order = np.lexsort((place, key, doc, h2, h1))
            s1, s2 = h1[order], h2[order]
            head = np.concatenate(([True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])))
            lead = order[head][np.cumsum(head) - 1]
            same = (doc[order] == doc[lead]) & (key[order] == key[lead]) & (place[order] == place[lead])
            # Rows that repeat the leading place are that place; all others come later.
            keep = order[head | ~same]
            late = ~(head[head | ~same])
            for a in range(0, len(keep), 1 << 16):
                k, z = keep[a:a + (1 << 16)], late[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(z, key[k] + place[k], h1[k])), pa.array(np.where(z, 0, h2[k])), ids.take(pa.array(at[k])),
                     pa.array(key[k]), pa.array(place[k] | z)], names=["h1", "h2", "doc_id", "text_key", "place"])

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over rows sorted by (h1, h2, doc_id, text_key, place): the places that are
    not the first of their span."""
    lead: pa.RecordBatch | None = None
    for batch in batches:
        if not len(batch):
            continue
        if lead is not None:
            batch = pa.Table.from_batches([lead, batch]).combine_chunks().to_batches()[0]
        cols = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
        num = {n: cols[n].to_numpy(zero_copy_only=False) for n in ("h1", "h2", "text_key", "place")}
        head = np.concatenate(([True], (num["h1"][1:] != num["h1"][:-1]) | (num["h2"][1:] != num["h2"][:-1])))
        top = np.flatnonzero(head)[np.cumsum(head) - 1]
        tops = cols["doc_id"].take(pa.array(top))
        same = np.asarray(pc.fill_null(pc.equal(cols["doc_id"], tops), False)) | np.asarray(
            pc.and_(cols["doc_id"].is_null(), tops.is_null()))
        gone = (num["place"] & _LATE == _LATE) | ~same | (num["text_key"] != num["text_key"][top]) | (num["place"] != num["place"][top])
        if lead is not None:
            gone[0] = False  # the row carried over, dealt with already
        use = np.flatnonzero(gone)
        yield pa.RecordBatch.from_arrays(
            [cols["doc_id"].take(pa.array(use)), cols["text_key"].take(pa.array(use)), pa.array(num["place"][use] & ~np.int64(_LATE))],
            names=["doc_id", "text_key", "place"])
        lead = batch.slice(int(top[-1]), 1)


def _cut(span: int, min_words: int, names: list[str]):
    """Removes the pieces covered by non-first spans; ``drop`` holds their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, _ROWS) for b in batches for a in range(0, len(b), _ROWS)):
            n = batch.schema.get_field_index
            drops = batch.column(n("__drop"))
            at, none = drops.offsets.to_numpy(), np.asarray(drops.is_null())
            place = drops.values.to_numpy(zero_copy_only=False)
            first, size = place >> _FIRST, (place & ((1 << _FIRST) - 1)) >> 1
            texts, total, removed = [], [], []
            for i, t in enumerate(batch.column(n("text"))):
                raw = b"" if not t.is_valid else t.as_py().encode("utf-8", "surrogatepass")
                bounds = sentence_bounds(raw.lower())
                gone = np.zeros(len(bounds) + 1, dtype=np.int64)
                if not none[i]:
                    own = slice(at[i], at[i + 1])
                    np.add.at(gone, first[own], 1)
                    np.add.at(gone, first[own] + size[own], -1)
                gone = np.cumsum(gone)[:-1] > 0
                total.append(len(bounds))
                removed.append(int(gone.sum()))
                texts.append(t.as_py() if not gone.any() else b"".join(
                    raw[a:b] for (a, b), x in zip(bounds, gone.tolist()) if not x).decode("utf-8", "surrogatepass"))
            new = {"text": pa.array(texts, pa.string()), "n_sentences": pa.array(total, pa.int64()),
                   "n_removed": pa.array(removed, pa.int64())}
            out = [*names, "n_sentences", "n_removed"]
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(n(c)) for c in out], names=out)

    return run


def remove_repeated_spans(docs: DataFrame, *, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (with doc_id, of any orderable type, and text) with ``text`` rid of every piece that a
    non-first repeated span covers, plus n_sentences (pieces) and n_removed.

    The first place of a span is the one with the smallest doc_id (nulls last),
    then the smallest text hash, then the earliest in its text.  Null and empty
    texts stay as they are.  Rows equal in doc_id and text count as one document
    and get the same result.  Other columns pass through; input columns named
    like an added one are replaced.  No rows: no rows.
    """
    base = without(docs, ADDED)
    names = base.columns
    keyed = base.withColumn("__key", F.xxhash64("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    places = (keyed.select("doc_id", "text", F.col("__key").alias("text_key"))
              .mapInArrow(_places(span, min_words), f"h1 long, h2 long, doc_id {kind}, text_key long, place long"))
    dealt = places.repartition("h1").sortWithinPartitions("h1", "h2", F.col("doc_id").asc_nulls_last(), "text_key", "place")
    gone = dealt.mapInArrow(_later, f"doc_id {kind}, text_key long, place long")
    drops = gone.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set("place").alias("__drop"))
    met = null_safe(keyed.withColumn("__id", F.col("doc_id")), drops, ["__id", "__key"], "left")
    schema = T.StructType([*base.schema, T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())])
    return met.select(*names, "__drop").mapInArrow(_cut(span, min_words, names), schema)
