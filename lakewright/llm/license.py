"""License scans: fuzzy search for short notices.

A notice with at most k edits is cut into k + 1 pieces: by the pigeonhole principle one of them stands in the
text unchanged. An automaton over all pieces locates them; round each, the regex library's bounded-error
matching verifies the edits and reports the span. Base phrases are found exactly, as consecutive words.
"""

from __future__ import annotations

import bisect
import functools
import heapq

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, word_places, words

#: Consecutive words and the label that they give.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices as words, with labels of the method's own.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version": "apache",
    "licensed under the bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the gnu general public license": "gnu-gpl",
    "licensed under the gnu lesser general public license": "gnu-lgpl",
    "licensed under the gnu affero general public license": "gnu-agpl",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons attribution": "creative-commons",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "rights-notice",
}
#: One edit for every so many characters of a notice.
CHARACTERS_PER_EDIT = 10
#: Names so short that an edit makes another licence of them: a match must hold its notice's unchanged.
SHORT_NAMES = frozenset(("mit", "bsd", "nc", "sa", "nd"))
MAX_EDITS = 4


def allowed(notice: str) -> int:
    return min(MAX_EDITS, len(notice) // CHARACTERS_PER_EDIT)


class Scanner:
    def __init__(self, notices: dict[str, str], base: dict[str, str]):
        self.notices = list(notices.items())
        self.base = [(f" {p} ".encode(), label) for p, label in base.items()]
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        for n, (notice, _) in enumerate(self.notices):
            k = allowed(notice)
            edges = [len(notice) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(edges, edges[1:]):
                pieces.setdefault(notice[a:b], []).append((n, a, b))
        for piece, held in pieces.items():
            self.automaton.add_word(piece, held)
        self.automaton.make_automaton()
        self.names = [SHORT_NAMES & set(t.split(" ")) for t, _ in self.notices]
        # (?b): of the matches in reach, the one of fewest edits.
        self.patterns = [regex.compile(rf"(?b)(?:{regex.escape(t)}){{e<={allowed(t)}}}") for t, _ in self.notices]

    def base_places(self, flat: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase in words joined and enclosed by single spaces."""
        found = []
        for phrase, label in self.base:
            at, word, last = flat.find(phrase), 0, 0
            while at >= 0:
                word += flat.count(b" ", last, at)
                last = at
                found.append((word, label))
                at = flat.find(phrase, at + 1)
        return found

    def fuzzy(self, flat: str) -> list[tuple[int, int, str, int]]:
        """(start, end, label, edits) of the notices in flat; of one notice the spans don't overlap.

        Windows that the seeds call for are merged for each notice before they are searched, so a text that
        repeats a piece is searched once.
        """
        windows: dict[int, list[list[int]]] = {}
        for end, held in self.automaton.iter(flat):
            for n, a, b in held:
                notice, k = self.notices[n][0], allowed(self.notices[n][0])
                start = end + 1 - b
                low, high = max(0, start - k), min(len(flat), start + len(notice) + k)
                own = windows.setdefault(n, [])
                if own and low <= own[-1][1] and own[-1][0] <= high:
                    own[-1] = [min(own[-1][0], low), max(own[-1][1], high)]
                else:
                    own.append([low, high])
        found = []
        for n, own in windows.items():
            for low, high in _merged(own):
                found += [(start, end, self.notices[n][1], edits) for edits, start, end in self.spans(n, flat, low, high)]
        # Where notices overlap, those with the fewest edits hold.
        return _fewest(found)

    def spans(self, n: int, flat: str, low: int, high: int) -> list[tuple[int, int, int]]:
        """(edits, start, end) of notice n in the window: always a span of fewest edits of those that overlap none
        taken before.

        What is left on both sides of a span is searched again. A long window is searched in parts that overlap by
        the longest match, so every match lies in one of them whole and no search runs over the whole window.
        """
        reach = len(self.notices[n][0]) + allowed(self.notices[n][0])
        taken: list[tuple[int, int]] = []
        heap: list[tuple[int, int, int, int, int]] = []

        def look(a: int, b: int) -> None:
            if best := self.best(n, flat, a, b):
                heapq.heappush(heap, (*best, a, b))

        for a in range(low, max(low + 1, high - reach), reach):
            look(a, min(high, a + 2 * reach))
        out = []
        while heap:
            edits, start, end, a, b = heapq.heappop(heap)
            i = bisect.bisect_left(taken, (end,))
            if not i or taken[i - 1][1] <= start:
                taken.insert(i, (start, end))
                out.append((edits, start, end))
            # Round all that is taken by now, this span or one of another part included.
            for start, end in taken[bisect.bisect_left(taken, (a + 1 - reach,)) : bisect.bisect_left(taken, (b,))]:
                if a < start:
                    look(a, start)
                a = max(a, end)
            if a < b:
                look(a, b)
        return out

    def best(self, n: int, flat: str, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the span of fewest edits in low..high that is notice n."""
        notice = self.notices[n][0]
        if high - low < len(notice) - allowed(notice):
            return None
        m = self.patterns[n].search(flat, low, high)
        if not m or m.end() <= m.start():
            return None
        edits = sum(m.fuzzy_counts)
        if not edits or self.names[n] <= set(m.group().split(" ")):
            return edits, m.start(), m.end()
        if not all(name in flat[low:high] for name in self.names[n]):
            return None
        # Another licence's notice is nearest: it must not hide one with the name, so every span is measured.
        held, limit = None, allowed(notice)
        for start in range(low, high):
            row = list(range(len(notice) + 1))
            for end in range(start, high):
                new = [row[0] + 1]
                for j, wanted in enumerate(notice):
                    new.append(min(row[j] + (flat[end] != wanted), row[j + 1] + 1, new[j] + 1))
                row = new
                if min(row) > limit:
                    break
                if row[-1] <= limit and self.names[n] <= set(flat[start : end + 1].split(" ")):
                    held, limit = (row[-1], start, end + 1), row[-1] - 1
        return held

def _fewest(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """found without those that one of fewer edits overlaps; any two of equal edits may overlap."""
    kept: list[tuple[int, int, str, int]] = []
    covered: list[list[int]] = []
    for edits in sorted({f[3] for f in found}):
        starts = [a for a, _ in covered]
        level = []
        for f in (f for f in found if f[3] == edits):
            i = bisect.bisect_right(starts, f[1] - 1) - 1
            if i < 0 or covered[i][1] <= f[0]:
                level.append(f)
        kept += level
        covered = _merged([*covered, *([a, b] for a, b, _, _ in level)])
    return kept


def _merged(windows: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


@functools.lru_cache(maxsize=4)
def _scanner(notices: tuple, base: tuple) -> Scanner:
    return Scanner(dict(notices), dict(base))


def _text(flat: bytes) -> str:
    return flat.decode("utf-8", "replace")


def find_notices(docs: DataFrame, notices: dict[str, str] = NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: for every document the notices found, as (label, start, end, edits).

    start and end are bytes of the original text, from the first to the last word that the notice touches.
    Null and empty texts have none.
    """
    own = (tuple(notices.items()), ())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner, out = _scanner(*own), []
        for value in as_bytes(batch.column(1)):
            spans = []
            if value:
                flat = _text(b" ".join(words(value)))
                found = scanner.fuzzy(flat)
                places = word_places(value) if found else []
                for start, end, label, edits in found:
                    first, last = flat.count(" ", 0, start + 1), flat.count(" ", 0, max(start + 1, end - 1))
                    spans.append({"label": label, "start": places[first][0], "end": places[last][1], "edits": edits})
            out.append(sorted(spans, key=lambda s: (s["start"], s["label"])))
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "spans": pa.array(out, kind)})

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, spans array<struct<label:string,start:bigint,end:bigint,edits:int>>")


def report(docs: DataFrame, notices: dict[str, str] = NOTICES, base: dict[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every whole document.

    n_base counts all places of base phrases; first_word and last_word are the smallest and largest word they
    start at, null without any. labels adds the method's labels to the base ones. score is 1 with a base
    phrase, else 1 less the share of edited characters in the best notice, 0 without any. Null and empty
    texts have no words. Repeated rows and null ids keep their rows. Map-only.
    """
    own = (tuple(notices.items()), tuple(base.items()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = _scanner(*own)
        n_words, n_base, first, last, base_labels, labels, scores = ([] for _ in range(7))
        for value in as_bytes(batch.column(1)):
            tokens = words(value)
            flat = b" %s " % b" ".join(tokens)
            places = scanner.base_places(flat) if tokens else []
            found = scanner.fuzzy(_text(flat)) if tokens else []
            exact = {label for _, label in places}
            n_words.append(len(tokens))
            n_base.append(len(places))
            first.append(min((w for w, _ in places), default=None))
            last.append(max((w for w, _ in places), default=None))
            base_labels.append(",".join(sorted(exact)))
            labels.append(",".join(sorted(exact | {label for _, _, label, _ in found})))
            best = max((1 - edits / max(1, end - start) for start, end, _, edits in found), default=0.0)
            scores.append(1.0 if places else max(0.0, best))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n_words": pa.array(n_words, pa.int64()),
                "n_base": pa.array(n_base, pa.int64()),
                "first_word": pa.array(first, pa.int64()),
                "last_word": pa.array(last, pa.int64()),
                "base_labels": pa.array(base_labels, pa.string()),
                "labels": pa.array(labels, pa.string()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_batches(source, run, schema)
