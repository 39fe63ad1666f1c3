"""Licence scan: Aho-Corasick over whole texts, shunting-yard over licence expressions.

One automaton holds every notice phrase and the identifier tag, on the text's
words; where a tag stands, the expression after it is parsed by a shunting-yard
parser (``with`` binds tighter than ``and``, ``and`` tighter than ``or``) and
evaluated: a document's score tells how freely it may be used.  A narrow map over
the documents: no shuffle, nothing gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gocledger.llm.common import arrow_map, utf8

# Fixed values of the contract: base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases of this operator.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc",
    "cc by nc nd": "cc-by-nc",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "the unlicense": "unlicense",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"

#: How freely text under a label may be used, 0 to 1; labels not listed: UNKNOWN.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "bsd": 0.95, "isc": 0.95, "bsl": 0.95,
    "apache": 0.9, "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.3, "cc-by-nc": 0.2, "proprietary": 0.05,
}
UNKNOWN = 0.5
#: An exception granted by ``with`` frees this part of what a licence withholds.
EXCEPTION = 0.25

#: Reserved words of expressions: no licence, or nothing said.  They name no label.
RESERVED = ("none", "noassertion")

_SEPARATORS = re.compile(rb"[^0-9a-z\x80-\xff]+")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: What may stand between a tag and its expression, and the expression.
_EXPRESSION = re.compile(rb"[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BINDING = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """Label of a licence identifier: the longest known label that starts it, else itself in lower case."""
    name = identifier.lower().rstrip("+")
    known = [k for k in FREEDOM if name == k or name.startswith(f"{k}-") or name.startswith(f"{k}+")]
    return max(known, key=len) if known else name


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: the expression's tokens in postfix order.

    The expression ends where it stops making sense (two operands in a row, an
    operator without operand, a closing parenthesis without opening one); a
    trailing operator is dropped and open parentheses are closed, so trailing
    prose or comment marks never fail.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = False

    def pop_to(binding: int) -> None:
        while stack and stack[-1] != "(" and _BINDING[stack[-1]] >= binding:
            out.append(stack.pop())

    for token in _TOKEN.findall(expression):
        op = token.lower()
        if op in _BINDING:
            if not operand:
                break
            pop_to(_BINDING[op])
            stack.append(op)
            operand = False
        elif token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand or "(" not in stack:
                break
            pop_to(0)
            stack.pop()
        else:
            if operand:
                break
            out.append(token)
            operand = True
    if not operand:
        while stack and stack[-1] == "(":
            stack.pop()
        if stack:
            stack.pop()
    while stack:
        op = stack.pop()
        if op != "(":
            out.append(op)
    return out


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """(labels, freedom) of a licence expression; None when it names no licence.
    ``or`` lets the user choose the freer side, ``and`` binds to the stricter one; a
    reserved word stands for a licence that is not known."""
    stack: list[tuple[set[str], float]] = []
    for token in to_postfix(expression):
        if token in _BINDING and len(stack) >= 2:
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, a + (1 - a) * EXCEPTION))
            else:
                stack.append((left | right, max(a, b) if token == "or" else min(a, b)))
        elif token not in _BINDING:
            label = label_of(token)
            stack.append((set(), UNKNOWN) if label in RESERVED else ({label}, FREEDOM.get(label, UNKNOWN)))
    return stack[-1] if stack and stack[-1][0] else None


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in [*BASE_PHRASES.items(), *NOTICE_PHRASES.items(), (TAG, None)]:
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def scan(text: str | None, automaton: ahocorasick.Automaton) -> dict:
    """All findings of one whole text (null: empty)."""
    # Words and single spaces, one character a byte: positions of spaces are word numbers.
    spaced = f" {_SEPARATORS.sub(b' ', utf8(text)).strip().decode('latin-1')} "
    n_words = spaced.count(" ") - 1 if len(spaced) > 2 else 0
    hits = sorted((end - len(phrase) - 1, phrase, label) for end, (phrase, label) in automaton.iter(spaced))
    at = word = n_base = 0
    first = last = None
    base: set[str] = set()
    labels: set[str] = set()
    tags: list[int] = []
    for start, phrase, label in hits:
        word += spaced.count(" ", at, start)
        at = start
        if phrase in BASE_PHRASES:
            n_base += 1
            first = word if first is None else first
            last = word
            base.add(label)
        if label is None:
            tags.append(word + phrase.count(" "))
        else:
            labels.add(label)
    freedom = [FREEDOM.get(x, UNKNOWN) for x in labels]
    expressions: list[str] = []
    if tags:
        # From the number of a tag's last word to its place in the text.
        raw = text.encode("utf-8", "surrogatepass")
        ends = iter(enumerate(m.end() for m in _WORD.finditer(utf8(text))))
        for tag in tags:
            behind = next(end for n, end in ends if n == tag)
            m = _EXPRESSION.match(raw, behind)
            expression = m[1].decode("utf-8", "surrogatepass").strip() if m else ""
            if (found := evaluate(expression)) is not None:
                labels |= found[0]
                freedom.append(found[1])
                expressions.append(expression)
    return {"n_words": n_words, "n_base": n_base, "first_word": first, "last_word": last,
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
            "score": min(freedom) if freedom else 0.0, "expressions": expressions}


ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("expressions", T.ArrayType(T.StringType())),
])


def license_scan(docs: DataFrame, *, text: str = "text", keep: Iterable[str] | None = None) -> DataFrame:
    """``docs`` plus the findings: n_words, n_base (places of base phrases, overlapping ones too),
    first_word and last_word (null without one), base_labels, labels, score, expressions.

    The score is the freedom of the strictest finding (0 without any).  Null and
    empty texts find nothing.  Repeated rows repeat their findings; input columns
    named like an added one are replaced.
    """
    made: list[ahocorasick.Automaton] = []  # one a task

    def rows(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(_automaton())
        out: dict[str, list] = {n: [] for n in ADDED.names}
        for t in batch.column(batch.schema.get_field_index(text)):
            for k, v in scan(t.as_py(), made[0]).items():
                out[k].append(v)
        return out

    return arrow_map(docs, rows, ADDED, keep)
