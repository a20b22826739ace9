"""License scan: ordered signature rules behind a keyword prefilter.

A text's words (A-Z lower-cased, punctuation left out) are matched by the regexes
of ``license_rules``; a rule is tried only where all its keywords stand. Of
overlapping detections, one whose words lie within a stronger one is suppressed:
by kind, then length, then place, then the order of the rules. Base phrases are
reported wherever they stand and are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from trueform.llm.common import byte_slices, flat_text
from trueform.llm.license_rules import KINDS, Rule, rules
from trueform.llm.textbytes import lower_ascii, runs

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_word_byte = np.ones(256, dtype=bool)
_word_byte[[*range(0x00, 0x30), *range(0x3a, 0x61), *range(0x7b, 0x80)]] = False

DETECTION = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("label", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
    T.StructField("start_byte", T.LongType()), T.StructField("end_byte", T.LongType()), T.StructField("score", T.DoubleType())])


class Scanner:
    """Compiled rules, grouped by the keywords that gate them."""

    def __init__(self, all_rules: tuple[Rule, ...]):
        self.rules = all_rules
        self.compiled = [re.compile(b"(?<= )(?:" + r.pattern.encode() + b")(?= )") for r in all_rules]
        gates: dict[frozenset[str], list[int]] = {}
        for i, r in enumerate(all_rules):
            gates.setdefault(r.keywords, []).append(i)
        self.gates = [(frozenset(k.encode() for k in keys), members) for keys, members in gates.items()]
        self.keywords = sorted({k for keys, _ in self.gates for k in keys})

    def candidates(self, low: bytes) -> list[int]:
        """Rules whose keywords all stand in the lower-cased text, as parts of words or whole."""
        found = {k for k in self.keywords if k in low}
        return sorted(i for keys, members in self.gates if keys <= found for i in members) if found else []

    def matches(self, words: bytes, tried: list[int]) -> list[tuple[int, int, int]]:
        """(first word, end word, rule) of all matches in words with one space before, between and behind them."""
        found = [(m.start(), m.end(), i) for i in tried for m in self.compiled[i].finditer(words)]
        if not found:
            return []
        blanks = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 32)
        at = np.searchsorted(blanks, np.array([f[:2] for f in found]))  # blanks before a word's start: its number and one more
        return [(int(a) - 1, int(b), i) for (a, b), (_, _, i) in zip(at, found)]

    def settle(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Detections that stay: not within a stronger one, or of a base rule. In order of place."""
        kept: list[tuple[int, int, int]] = []
        for kind in range(len(KINDS)):
            same = sorted((x for x in found if self.rules[x[2]].priority == kind), key=lambda x: (x[0], -x[1], x[2]))
            if not same:
                continue
            if self.rules[same[0][2]].base:
                kept += same
                continue
            stronger = sorted((a, b) for a, b, _ in kept)
            starts, reach = [a for a, _ in stronger], list(accumulate((b for _, b in stronger), max))
            end = -1
            for a, b, i in same:
                before = bisect_right(starts, a)
                inside = b <= end or (before and reach[before - 1] >= b)
                end = max(end, b)
                if not inside:
                    kept.append((a, b, i))
        return sorted(kept)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    """Kept by a Python worker from task to task."""
    return Scanner(rules())


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, detections, n_suppressed of each row's whole text.

    A detection names its rule, label and kind, the words it covers (from 0; the
    end is the word behind it), their UTF-8 bytes in the text and the kind's score.

    Null and empty text has no words and no detections. Null or repeated doc_id and
    repeated rows are carried as they are; other columns are ignored; an empty table
    gives no row.
    """
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("detections", T.ArrayType(DETECTION)), T.StructField("n_suppressed", T.LongType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        own, kind = scanner(), to_arrow_type(schema["detections"].dataType)
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                flat, offsets = flat_text(batch.column("text"))
                low = lower_ascii(flat)
                starts, ends, at = runs(_word_byte[low], offsets)
                data = low.tobytes()
                lists, suppressed = [], []
                for row in range(batch.num_rows):
                    text = data[offsets[row]:offsets[row + 1]]
                    tried = own.candidates(text)
                    found = own.matches(b" " + b" ".join(WORD.findall(text)) + b" ", tried) if tried else []
                    kept = own.settle(found)
                    suppressed.append(len(found) - len(kept))
                    lists.append([{"rule": r.name, "label": r.label, "kind": r.kind, "first_word": a, "end_word": b,
                                   "start_byte": int(starts[at[row] + a] - offsets[row]), "end_byte": int(ends[at[row] + b - 1] - offsets[row]),
                                   "score": KINDS[r.kind]} for a, b, r in ((a, b, own.rules[i]) for a, b, i in kept)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), pa.array(lists, kind), pa.array(suppressed, pa.int64())],
                    names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(find, schema)
