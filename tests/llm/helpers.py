"""Tables with every odd row the operators have to stand."""

from __future__ import annotations

import re
from collections import defaultdict

LONG = " ".join(f"w{k % 997} the" for k in range(30_000))
#: doc_id, text, lang, source: repeated rows, nulls in every column, empty, blank and very long texts.
ODD_ROWS = [
    (1, "One line of text here\nAnother line of text here", "en", "a"),
    (1, "One line of text here\nAnother line of text here", "en", "a"),
    (None, "a text without an id, long enough to have some words in it", "en", "b"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, " \t\n\x0b ", "de", "b"),
    (5, LONG, "en", "c"),
    (6, "Ünïcode wörds 中文 \U0001f600 and İ\n\nend\r\n", None, "c"),
    (7, "x" * 5000, "fr", None),
    (None, None, None, None),
]
#: Names that operators use themselves.
CLASHING = {
    "row": 1, "key": 2, "size": 3, "n_words": 4, "score": 5, "predicted": 6, "kept": 7, "host": 8, "n_lines": 9, "fp": 10,
    "component_id": 11, "target": 12, "copies": 13, "a.b": 14, "_h1": 15, "y": 16, "n_tokens": 17, "place": 18, "tie": 19,
}


def odd_documents(spark, rows=ODD_ROWS):
    """The odd rows with extra columns of clashing names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return docs.select("*", *(F.lit(v).alias(n) for n, v in CLASHING.items()))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def components(nodes, linked) -> dict:
    """Smallest node reachable from each, by depth-first search over a list of links."""
    near = defaultdict(set)
    for a, b in linked:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for start in sorted(nodes):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in found:
                found[node] = start
                stack.extend(near[node])
    return found
