"""Substring dedup, fuzzy line dedup, embedding near-dedup and the union-find below them."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gocledger.llm import embeddings, linedup, queries, spans
from gocledger.llm.common import Scratch
from gocledger.llm.components import connected_components
from corpus_helpers import docs, empty, odd_rows, prose


def components(n, edges):
    label = list(range(n))
    for a, b in edges:
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    return label


# ------------------------------------------------------------------ union-find
def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (210, 211), (211, 210), (210, 211)]
    edges += [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    rng.shuffle(edges)
    got = connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), Scratch(spark)).collect()
    label = components(400, edges)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {n: label[n] for n in nodes} and len(got) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


# ------------------------------------------------------------------ spans
def brute_spans(rows, span=3, min_words=12):
    """Removed sentence numbers per distinct (doc_id, text), from a dictionary of all spans."""
    first, seen = {}, {}
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    for d in order:
        for a, n, h in spans.text_spans(d[1], span, min_words):
            first.setdefault(h, (d, a))
            seen.setdefault(d, []).append((a, n, h))
    return {d: {i for a, n, h in s if first[h] != (d, a) for i in range(a, a + n)} for d, s in seen.items()}


def test_spans_match_brute_force(spark):
    rng = random.Random(6)
    shared = [prose(900 + i, 70) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i, rng.randrange(5, 60))]
        for _ in range(rng.randrange(3)):
            parts.append(rng.choice(shared))
            parts.append(prose(rng.randrange(10**6), rng.randrange(5, 40)))
        rows.append((1000 - i, rng.choice([". ", "\n", " "]).join(parts)))
    rows += [r[:2] for r in odd_rows()]
    out = spans.remove_repeated_spans(docs(spark, rows).repartition(5)).collect()
    gone = {k: v for k, v in brute_spans([r for r in rows]).items()}
    text = dict()
    for r in rows:
        text.setdefault(r[0], set()).add(r[1])
    assert len(out) == len(rows)
    want = sorted((str(d), "".join(t.encode()[a:b].decode() for i, (a, b) in enumerate(spans.sentence_bounds(t.encode().lower()))
                                   if i not in gone.get((d, t), ()))) for d, t in rows if t is not None)
    assert sorted((str(r.doc_id), r.text) for r in out if r.text is not None) == want
    assert sum(r.n_removed for r in out) > 100


def test_a_shared_passage_stays_once(spark):
    passage = prose(77, 90)
    rows = [(i, f"{prose(i, 30)}\n{passage}\n{prose(50 + i, 30)}") for i in (5, 3, 9)] + [(20, "Lead in without a stop " + passage + " and on")]
    out = {r.doc_id: r.text for r in spans.remove_repeated_spans(docs(spark, rows)).collect()}
    core = " ".join(passage.split()[20:60])
    assert [d for d, t in out.items() if core in t] == [3]
    for i in (5, 9):
        assert out[i].startswith(prose(i, 30)) and out[i].endswith(prose(50 + i, 30))


def test_spans_edges(spark):
    assert spans.remove_repeated_spans(empty(spark)).count() == 0
    same = spans.remove_repeated_spans(docs(spark, [(1, prose(1, 80)), (1, prose(1, 80)), (2, "short"), (3, "short"), (4, ""), (5, None), (6, "..."), (7, "...")])
                                       .selectExpr("*", "1 as n_removed", "2 as __drop2")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in same) == [(1, 0), (1, 0), (2, 0), (3, 1), (4, 0), (5, 0), (6, 0), (7, 0)]


STOPS = "。！？．｡।؟۔"


def own_pieces(text):
    """[(text, words, sentence number)] character by character, without the module's segmentation."""
    import zlib

    def unspaced(c):
        o = ord(c)
        return 0xE00 <= o < 0xF00 or 0x1000 <= o < 0x10C0 or 0x1780 <= o < 0x1800 or 0x3040 <= o < 0xA000 or 0x20000 <= o < 0x40000

    def in_word(c):
        o = ord(c)
        return c in "0123456789abcdefghijklmnopqrstuvwxyz" or (
            o > 127 and not unspaced(c) and c not in STOPS and not 0x3000 <= o < 0x3040 and not 0xFF00 <= o < 0xFF80)

    low, sentences, at = [c.lower() if c.isascii() else c for c in text], [], 0
    i = 0
    while i < len(low):
        c, j = low[i], i + 1
        if c in ".!?":
            while j < len(low) and low[j].isascii() and not low[j].isalnum() and not low[j].isspace():
                j += 1
            if j == len(low) or low[j] not in " \t\n\r\x0b\x0c":
                # marks may hold further stops: try from the next character
                i += 1
                continue
        elif c in STOPS:
            while j < len(low) and low[j] in STOPS:
                j += 1
        elif c not in "\r\n":
            i += 1
            continue
        while j < len(low) and low[j] in " \t\n\r\x0b\x0c":
            j += 1
        sentences.append((at, j))
        at = i = j
    if at < len(low):
        sentences.append((at, len(low)))
    out = []
    for k, (a, b) in enumerate(sentences):
        words, i = [], a
        while i < b:
            if unspaced(low[i]):
                words.append((i, i + 1))
            elif in_word(low[i]):
                j = i
                while j < b and in_word(low[j]):
                    j += 1
                words.append((i, j))
                i = j
                continue
            i += 1
        begin, held = a, []
        for n, (x, y) in enumerate(words):
            held.append("".join(low[x:y]))
            if n >= 8 and zlib.crc32(held[-1].encode()) % 4 == 0:
                out.append((text[begin:y], held, k))
                begin, held = y, []
        if begin < b:
            out.append((text[begin:b], held, k))
    return out


def own_runs(sizes, span=3, least=12):
    """All (first, last) of sliding runs by their definition."""
    full, out = [i for i, n in enumerate(sizes) if n], []
    for k in range(len(full)):
        for m in range(k + span - 1, len(full)):
            if sum(sizes[i] for i in full[k:m + 1]) >= least:
                out.append((k, m))
                break
    # a run is never shorter than the one before it
    fixed, end = [], 0
    for k, m in out:
        end = max(end, m)
        fixed.append((k, end))
    if full and not fixed:
        fixed = [(0, len(full) - 1)]
    elif full and fixed[-1][1] < len(full) - 1:
        k = max(k for k in range(len(full)) if len(full) - k >= span and sum(sizes[i] for i in full[k:]) >= least)
        fixed.append((k, len(full) - 1))
    return [(full[k], full[m]) for k, m in fixed]


def own_removed(rows):
    """{(doc, text): text left} by the definition, from plain lists."""
    places, pieces = {}, {}
    for d, t in sorted(set(rows)):
        pieces[d, t] = p = own_pieces(t)
        runs = set(own_runs([len(w) for _, w, _ in p]))
        n = 1 + max((k for _, _, k in p), default=-1)
        first = [min(i for i, x in enumerate(p) if x[2] == k) for k in range(n)]
        last = [max((i for i, x in enumerate(p) if x[2] == k and x[1]), default=first[k]) for k in range(n)]
        runs |= {(first[a], last[b]) for a, b in own_runs([sum(len(w) for _, w, j in p if j == k) for k in range(n)])}
        for a, b in runs:
            places.setdefault(tuple(w for _, ws, _ in p[a:b + 1] for w in ws), []).append((d, a, b, t))
    gone = {}
    for found in places.values():
        top = min(x[:2] for x in found)
        for d, a, b, t in found:
            if (d, a) != top:
                gone.setdefault((d, t), set()).update(range(a, b + 1))
    return {k: "".join(x for i, (x, _, _) in enumerate(p) if i not in gone.get(k, ())) for k, p in pieces.items()}


def test_spans_match_their_definition(spark):
    """Own segmentation: short texts, tails, scripts without blanks, stops without blanks, headings."""
    rng = random.Random(21)
    han = "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生"
    kana = "あいうえおかきくけこさしすせそたちつてと日本語"

    def sentence():
        kind = rng.randrange(6)
        if kind == 0:
            return "".join(rng.choice(han) for _ in range(rng.randrange(2, 14))) + rng.choice("。！？")
        if kind == 1:
            return "".join(rng.choice(kana) for _ in range(rng.randrange(2, 20))) + "。"
        if kind == 2:
            return rng.choice(["Heading\n", "- ", "x. ", "…", '"Yes!" ', "3.14 ", "e.g. ", "काम।", "कुछ और। "])
        return " ".join(rng.choice(["Alpha", "béta", "gamma", "Ünder", "x1", "delta's", "naïve", "w"]) + str(rng.randrange(30))
                        for _ in range(rng.randrange(1, 25))) + rng.choice([". ", "! ", ".\n", "?) "])

    shared = ["".join(sentence() for _ in range(rng.randrange(2, 7))) for _ in range(8)]
    rows = []
    for i in range(70):
        parts = [sentence() for _ in range(rng.randrange(0, 6))]
        if i % 2:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((500 - i, "".join(parts)))
    for n in range(1, 14):                                  # texts of 1 to 13 words, three times each
        rows += [(1000 + 3 * n + k, " ".join(f"s{n}w{j}" for j in range(n))) for k in range(3)]
    rows += [(2000 + k, "".join(kana[(7 * j + j // 5) % len(kana)] + ("。" if j % 9 == 8 else "") for j in range(270))) for k in range(2)]
    rows += [(3000 + k, "x. " * 40) for k in range(2)]
    out = {(r.doc_id, r.doc_id): r.text for r in spans.remove_repeated_spans(docs(spark, rows).repartition(4)).collect()}
    want = own_removed(rows)
    for d, t in rows:
        assert out[d, d] == want[d, t], (d, t, want[d, t])
    assert sum(out[d, d] == "" for d, _ in rows) >= 2 * 13 + 2 and any(out[d, d] not in ("", t) for d, t in rows)


def test_string_ids_and_null_ids(spark):
    t = prose(5, 60)
    df = spark.createDataFrame([("b", t), ("a", t), (None, t), ("c", prose(6, 60))], "doc_id string, text string")
    out = spans.remove_repeated_spans(df).collect()
    assert {r.doc_id: r.text == "" for r in out} == {"a": False, "b": True, None: True, "c": False}


# ------------------------------------------------------------------ lines
def brute_lines(rows, similarity=0.8):
    """Places (doc, line) that go, from all pairs of lines."""
    places = {}
    for d, t in {(r[0], r[1]) for r in rows}:
        for i, line in enumerate((t or "").split("\n") if t is not None else []):
            if re.search(r"\S", line):
                places.setdefault(line, []).append((d is None, d or 0, i))
    lines = sorted(places)
    sets = [five_grams(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i)
             if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]
    label = components(len(lines), links)
    groups = {}
    for x, c in zip(lines, label):
        groups.setdefault(c, []).extend(places[x])
    return {p for g in groups.values() for p in g if p != min(g)}, len(links)


def test_fuzzy_lines_match_brute_force(spark):
    rng = random.Random(9)
    base = [prose(i, 40) for i in range(12)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(4):
            w = rng.choice(base).split()
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
            text.append(" ".join(w))
        text.insert(2, rng.choice(["", "  ", "tiny", "own line " + str(i)]))
        rows.append((i, "\n".join(text)))
    want, links = brute_lines(rows)
    for block in (256, 4):
        got = {(False, r.doc_id, i) for r in linedup.repeated_lines(docs(spark, rows), Scratch(spark), block=block).collect()
               for i in r.removed}
        assert got == want and links > 50, block


def test_lines_odd_rows_and_text(spark):
    odd = odd_rows() + [(30, "same line here\n\nsame line here\nother"), (31, "x\nsame line here")]
    df = docs(spark, odd).selectExpr("*", "1 as removed", "2 as band")
    out = linedup.dedup_lines(df, Scratch(spark))
    assert out.columns == df.columns and out.count() == len(odd)
    text = {r.doc_id: r.text for r in out.where("doc_id >= 30").collect()}
    assert text == {30: "same line here\n\nother", 31: "x"}
    ones = [r.text for r in out.where("doc_id = 1").collect()]
    assert ones == [prose(1, 60)] * 2                                  # repeated rows are one document
    assert [r.text for r in out.where("doc_id = 7").collect()] == [""]  # copy of document 1
    assert linedup.dedup_lines(empty(spark), Scratch(spark)).count() == 0


def five_grams(line):
    return {line[i:i + 5] for i in range(max(len(line) - 4, 1))}


def test_char_shingles_start_at_every_character(spark):
    lines = ["plain words here", "x" * 40, "abc", "日本語" * 10, "a😀bc😀de", " lead", "tab\tsplit", "four"]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(F.size(linedup.char_shingles(F.col("line"))).alias("n")).collect()
    assert [r.n for r in got] == [len(five_grams(x)) for x in lines]


def test_one_character_edits_are_found(spark):
    rng = random.Random(11)
    lines = []
    for n in range(5, 21):
        for k in range(4):
            line = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(n))
            at = rng.randrange(len(line))
            lines += [line, line[:at] + "#" + line[at + 1:]]
    sets = [five_grams(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    label = components(len(lines), links)
    want = {i for i, c in enumerate(label) if i != c}
    df = docs(spark, list(enumerate(lines)))
    for block in (256, 1):
        got = {r.doc_id for r in linedup.repeated_lines(df, Scratch(spark), block=block).collect()}
        assert got == want and len(want) > 40, block


def test_registered_banding_finds_pairs_at_the_threshold(spark, tmp_path):
    rng = random.Random(12)
    lines = []
    for _ in range(400):
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=94))
        lines += [line, line[:30] + "#" + line[31:60] + "#" + line[61:]]     # 80 shared shingles of 100
    near = [len(five_grams(x) & five_grams(y)) >= 0.8 * len(five_grams(x) | five_grams(y)) - 1e-9 for x, y in zip(lines[::2], lines[1::2])]
    docs(spark, list(enumerate(lines))).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id for r in queries.op7_lines(spark, str(tmp_path)).where("n_removed > 0").collect()}
    want = {2 * i + 1 for i, x in enumerate(near) if x}
    assert got <= want and len(want) > 350 and len(got) >= 0.999 * len(want)


def test_signing_makes_a_row_of_many_shingles(spark):
    """The minima are those over all shingles, but a shingle is no row of its own (166 million rows on 0.10 GB)."""
    lines = ["abc", "five5", "x" * 40, "日本語" * 10, "a😀bc😀de"] + [prose(i, n)[:c] for i, (n, c) in enumerate([(9, 20), (9, 21), (40, 999)])]
    df = linedup._hashed(spark.createDataFrame([(x,) for x in lines + lines[:3]], "line string"), 7)
    got = {(r.h1, r.h2): r for r in linedup._signed(df, 5, 16, 3, 7).collect()}

    def least(mask):
        return F.array_min(F.transform(linedup.char_shingles(F.col("line")), lambda h: h.bitwiseXOR(F.lit(mask))))

    low = df.select("h1", "h2", F.array(*[least(m) for m in linedup._masks(48, 7)]).alias("m"))
    keys = low.select("h1", "h2", *[F.xxhash64(F.lit(b), *[F.col("m")[3 * b + i] for i in range(3)]).alias(f"b{b}") for b in range(16)])
    want = {(r.h1, r.h2): r for r in keys.distinct().collect()}
    assert got == want and len(got) == len(lines)
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(
        F.explode(linedup._runs(linedup._last(F.col("line"), 5)))).count()
    assert rows == sum(-(-max(len(x) - 4, 1) // linedup.RUN) for x in lines) < sum(max(len(x) - 4, 1) for x in lines) / 8


def test_sketches_part_unlinked_lines_only(spark):
    """Bitmaps and thinned shingles exclude no linked pair and nearly all unlike ones, short lines and long ones."""
    rng = random.Random(13)
    lines = ["abc", "five5", "x. " * 700, "x. " * 500]
    for n in (6, 20, 60, 150, 400):                                       # words: the last two kinds have more shingles than bits
        for _ in range(4):
            words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(n)]
            lines.append(" ".join(words))
            for share in (0.01, 0.03, 0.2):
                lines.append(" ".join(w if rng.random() > share else f"e{rng.randrange(99)}" for w in words))
    lines = sorted(set(lines))
    df = linedup._hashed(spark.createDataFrame([(x,) for x in lines], "line string"), 7)
    sketch = linedup._sketched(df, 5, 16, 3, 7).join(df.select("h1", "line"), "h1").select("line", *linedup._MARKS)
    one, other = [sketch.select([F.col(c).alias(p + c) for c in sketch.columns]) for p in ("x_", "y_")]
    kept = {(r.x_line, r.y_line) for r in one.join(other, F.col("x_line") < F.col("y_line")).where(
        linedup._may_link("x_", "y_", 0.8)).select("x_line", "y_line").collect()}
    sets = {x: five_grams(x) for x in lines}
    pairs = {(x, y): len(sets[x] & sets[y]) / len(sets[x] | sets[y]) for x in lines for y in lines if x < y}
    links = {p for p, j in pairs.items() if j >= 0.8 - 1e-9}
    unlike = {p for p, j in pairs.items() if j < 0.4}
    assert links <= kept and len(links) > 20
    assert len(kept & unlike) < 0.02 * len(unlike) and sketch.where("thin is not null").count() >= 16


def test_scratch_tables_of_lines_go_when_read(spark):
    """Texts, sketches, pairs and links are deleted before the result is made: two tables are left for it."""
    rows = [(i, prose(i % 5, 30) + (f" edit{i}" if i % 2 else "") + "\n" + prose(40 + i, 12)) for i in range(20)]
    scratch = Scratch(spark)
    removed = linedup.repeated_lines(docs(spark, rows), scratch)
    assert len(scratch.paths) == 2
    want, _ = brute_lines(rows)
    assert {(False, r.doc_id, i) for r in removed.collect() for i in r.removed} == want and want


def test_line_feeds_alone_separate_lines(spark):
    """A carriage return belongs to its line: a line with one differs from the line without by that character."""
    rows = [(1, "one line of text\r\nanother line of text\r\n"), (2, "one line of text\r\nsomething else altogether"), (3, "x\ry")]
    out = {r.doc_id: r.text for r in linedup.dedup_lines(docs(spark, rows), Scratch(spark)).collect()}
    assert out == {1: "one line of text\r\nanother line of text\r\n", 2: "something else altogether", 3: "x\ry"}


def test_lines_plan_is_native(spark):
    plan = linedup.repeated_lines(docs(spark, [(1, "a b"), (2, "a b")]), Scratch(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ embeddings
def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 24))
    rows, x = [], []
    for i in range(40):
        for c in range(1 + i % 6):
            v = base[i] + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.15, 0.3])
            x.append(v.astype(np.float32).astype(float))
    ids = rng.permutation(len(x)).tolist()
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, x)]
    u = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    label = components(len(x), [(i, j) for i, j in zip(*np.nonzero(link))])
    least = {}
    for i, c in zip(ids, label):
        least[c] = min(least.get(c, 1 << 60), i)
    for block in (1024, 2):
        got = {r.vec_id: r for r in embeddings.near_duplicates(vectors(spark, rows), Scratch(spark), block=block).collect()}
        found = sum(r.n_links for r in got.values())
        assert found >= 0.9 * link.sum() and all(got[i].n_links <= n for i, n in zip(ids, link.sum(axis=1)))
        exact = np.mean([got[i].component_id == least[c] for i, c in zip(ids, label)])
        assert exact > 0.95 and link.sum() > 60


def test_registered_query_finds_planted_links(spark, tmp_path):
    """Thousands of vectors, pairs planted at cosines from 0.93 to 1: links found, none below the threshold."""
    rng = np.random.default_rng(14)
    base = rng.standard_normal((3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = []
    for i in range(1500):
        side = rng.standard_normal(64)
        side -= (side @ base[i]) * base[i]
        side /= np.linalg.norm(side)
        c = 0.93 + 0.07 * i / 1499
        near.append((c * base[i] + np.sqrt(max(0.0, 1 - c * c)) * side) * rng.uniform(0.1, 10))
    x = np.concatenate([base, near]).astype(np.float32)
    spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    got = {r.vec_id: r for r in queries.op6_embeddings(spark, str(tmp_path)).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cos = u @ u.T
    np.fill_diagonal(cos, 0)
    want = (cos >= 0.95).sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert len(got) == len(x) and want.sum() > 2000
    assert (found <= want).all()                                         # nothing below the threshold
    assert found.sum() >= 0.99 * want.sum(), (found.sum(), want.sum())
    label = components(len(x), [(i, j) for i, j in np.argwhere(np.triu(cos >= 0.95)).tolist()])
    assert np.mean([got[i].component_id == label[i] and got[i].kept == (label[i] == i) for i in range(len(x))]) >= 0.99
    print("recall", found.sum() / want.sum())


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 0), (4, None, None), (5, [], 0), (6, [0.0, 0.0, 0.0], 0),
            (7, [nan, 1.0, 0.0], 0), (8, [inf, 0.0, 0.0], 0), (9, [None, 1.0, 0.0], 0), (10, [1.0, 0.0], 0), (11, [0.0, 1.0, 0.0], 0),
            (None, [0.0, 1.0, 0.0], 0), (3, [0.0, 0.0, 1.0], 0), (12, [1e-30, 0.0, 0.0], 0), (13, [1.0], 0), (14, [3.0], 1)]
    out = embeddings.near_duplicates(vectors(spark, rows, "double").selectExpr("*", "1 as n_links", "2 as cid"), Scratch(spark)).collect()
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in out)
    assert got == sorted([("1", 3, "1"), ("2", 3, "1"), ("3", 3, "1"), ("12", 3, "1"), ("4", 0, "4"), ("5", 0, "5"), ("6", 0, "6"),
                          ("7", 0, "7"), ("8", 0, "8"), ("9", 0, "9"), ("10", 0, "10"), ("11", 1, "11"), ("None", 1, "11"), ("3", 0, "3"),
                          ("13", 1, "13"), ("14", 1, "13")])
    assert embeddings.near_duplicates(vectors(spark, []), Scratch(spark)).count() == 0


def test_recall_is_planned_for_the_threshold():
    for n, dims in ((500, 64), (10**6, 64), (10**4, 16)):
        width, tables = embeddings.plan(n, dims, 0.95, 0.999)
        h = embeddings.Hasher(dims, width, tables)
        rng = np.random.default_rng(0)
        a = rng.standard_normal((400, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.standard_normal((400, dims))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        met = (h.buckets(a)[:, :, :, None] == h.buckets(b)[:, :, None, :]).any(axis=(1, 2, 3))
        assert met.mean() > 0.97


def test_recall_is_kept_where_many_tables_are_needed():
    width, tables = embeddings.plan(10**6, 64, 0.5, 0.999)
    assert tables <= 64 and width < embeddings.plan(10**6, 64, 0.95, 0.999)[0]
    h = embeddings.Hasher(64, width, tables)
    rng = np.random.default_rng(1)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((400, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.5 * a + np.sqrt(1 - 0.5**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = (h.buckets(a)[:, :, :, None] == h.buckets(b)[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.99
    with pytest.raises(ValueError):
        embeddings.plan(500, 64, 0.05, 0.999)
