"""License scans: exact base phrases, and short notices found with bounded errors.

Fuzzy search splits each notice into errors + 1 pieces: any match within that many edits holds
one piece unchanged (pigeonhole). All pieces are searched in one automaton pass; only around a
hit does the ``regex`` library match the whole notice with bounded errors and give its span.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from roadflow.llm.common import table
from roadflow.llm.registry import query

#: Phrases whose exact places are counted, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Notices searched with errors: (words, label, greatest number of edited characters).
NOTICES = (
    ("released under the mit license", "mit", 3),
    ("licensed under the apache license version 2", "apache-2", 4),
    ("licensed under cc by nc", "cc-by-nc", 2),
    ("licensed under the gnu general public license version 3", "gpl-3", 5),
    ("licensed under the gnu general public license version 2", "gpl-2", 5),
    ("gnu lesser general public license", "lgpl", 3),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("subject to the terms of the mozilla public license", "mpl", 4),
    ("all rights reserved", "all-rights-reserved", 1),
)
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, notices array<struct<label:string,first_word:long,last_word:long,errors:int,text:string>>"
)
_NOTICE = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32()), ("text", pa.string())])


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length, with their offsets."""
    n, k = len(notice), errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds base phrases and notices in one text; built once per task."""

    def __init__(self, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str, int]]):
        import ahocorasick
        import regex

        self.base, self.notices, self.found = base, notices, ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (phrase, _) in enumerate(base):
            seeds.setdefault(f" {phrase} ", []).append((-1 - i, 0))
        for i, (notice, _, errors) in enumerate(notices):
            for at, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((i, at))
        for seed, uses in seeds.items():
            self.found.add_word(seed, (len(seed), uses))
        self.found.make_automaton()
        # (?b): the best match in the window, not the first within the bound.
        self.fuzzy = [regex.compile(rf"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={e}}}") for n, _, e in notices]

    def scan(self, text: bytes) -> tuple:
        words = text.translate(_TO_WORDS).split()
        line = " " + b" ".join(words).decode("utf-8", "replace") + " "
        places, windows = [], [[] for _ in self.notices]
        for end, (size, uses) in self.found.iter(line):
            start = end - size + 1
            for i, at in uses:
                if i < 0:
                    places.append((line.count(" ", 0, start), self.base[-1 - i][1]))
                else:
                    notice, _, errors = self.notices[i]
                    low = max(0, start - at - errors)
                    high = min(len(line), start - at + len(notice) + errors)
                    if windows[i] and low <= windows[i][-1][1]:
                        windows[i][-1][1] = max(high, windows[i][-1][1])
                    else:
                        windows[i].append([low, high])
        notices = []
        for i, (notice, label, _) in enumerate(self.notices):
            for low, high in windows[i]:
                at = low
                while m := self.fuzzy[i].search(line, at, high):
                    first = line.count(" ", 0, m.start() + (line[m.start()] == " ")) - 1
                    last = line.count(" ", 0, max(m.end() - 1, m.start() + 1)) - 1
                    notices.append((label, max(first, 0), max(last, first, 0), sum(m.fuzzy_counts), m[0].strip(), 1 - sum(m.fuzzy_counts) / len(notice)))
                    at = max(m.end(), at + 1)
        return len(words), places, notices


def scan_licenses(
    documents: DataFrame, base: Sequence[tuple[str, str]] = BASE, notices: Sequence[tuple[str, str, int]] = NOTICES
) -> DataFrame:
    """One row per document: base places and labels, found notices with spans and edits, score.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII; a null
    text is empty. ``score`` is 1 for a base phrase, else the share of the best notice's
    characters that needed no edit, 0 without any. Repeated rows each give their own row; other
    columns are ignored. Memory of a task: one batch of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.binary())
            columns: list[list] = [[] for _ in range(8)]
            for value in texts:
                n, places, found = scanner.scan(value.as_py() or b"")
                starts = [p for p, _ in places]
                own = {label for _, label in places}
                row = (
                    n,
                    len(places),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(own)),
                    ",".join(sorted(own | {x[0] for x in found})),
                    1.0 if places else max((x[5] for x in found), default=0.0),
                    [dict(zip(("label", "first_word", "last_word", "errors", "text"), x[:5], strict=True)) for x in found],
                )
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(_NOTICE)]
            names = [x.strip().split()[0] for x in SCHEMA.split(", ")[:8]] + ["notices"]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("notices")
