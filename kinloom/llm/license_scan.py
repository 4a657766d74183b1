"""License scans by conditional compression.

A block around a cue word is compressed alone and with each template that it can hold as raw
zstandard dictionary. The templates are ranked by the reduction in size, and down that ranking
those are confirmed whose wording the block has, on spans that do not overlap: at least 90 %
of a template's words in order inside a span of at most 1.3 times its length, with no
number, negation or licence suffix among the differences. A block can hold a template only if it has
one of its rarest words, one more than it may lack, so other templates are not tried.

Blocks are the sentence, the line, the paragraph of a cue, and the run of paragraphs with cues
around it, as far as twice the longest template on either side, so that every template fits.
Texts are scanned whole and where they lie; only findings leave a task.

Words are compared in lower case, without list markers; ``licence`` is ``license``.

Defined cases: null and blank texts and empty tables have no findings; of overlapping findings the
one that saves more bytes stays, ties to the earlier and shorter; repeated rows
each give their findings, ids may be null; texts may have any length; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import ship
from kinloom.llm.license_templates import CUES, TEMPLATES

LEAST = 0.9
REACH = 2 * max(len(t) for texts in TEMPLATES.values() for t in texts)
_CUE = re.compile("|".join(map(re.escape, CUES)), re.IGNORECASE)
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+(?:[.][0-9]+)*")
_MARKER = re.compile(r"(?:^|(?<=[\n:;.]))(\s*)(?:\(?[0-9]{1,2}[.)]|\([a-z]\))(?=\s)")
#: Words whose presence or absence changes the license.
_DECISIVE = frozenset("not no non nc nd sa by lesser affero later noncommercial noderivatives sharealike attribution".split())


def normal_words(text: str) -> list[tuple[str, int, int]]:
    """Words with their places; list markers are none."""
    plain = _MARKER.sub(lambda m: m[1] + " " * (len(m[0]) - len(m[1])), text)
    return [("license" if (w := m[0].lower()) == "licence" else w, m.start(), m.end()) for m in _WORD.finditer(plain)]


class Templates:
    def __init__(self, templates: dict = TEMPLATES):
        self.all = []
        for name, texts in templates.items():
            for text in texts:
                words = [w for w, _, _ in normal_words(text)]
                packed = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
                self.all.append((name, text, words, packed))
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.done: dict = {}
        seen = Counter(w for t in self.all for w in set(t[2]))
        self.by_word: dict[str, list[int]] = {}
        for i, t in enumerate(self.all):
            may_lack = int((1 - LEAST) * len(t[2]) + 1e-9)
            for w in sorted(set(t[2]), key=lambda w: (seen[w], w))[: may_lack + 1]:
                self.by_word.setdefault(w, []).append(i)

    def possible(self, bag: set[str]) -> list[int]:
        """Templates of whose words the block may have enough."""
        near = {i for w in bag for i in self.by_word.get(w, ())}
        return sorted(i for i in near if sum(w in bag for w in self.all[i][2]) >= LEAST * len(self.all[i][2]))

    def ranked(self, block: str, of: Iterable[int] | None = None) -> list[tuple[int, float, int]]:
        """Bytes saved, their share and the template, by bytes saved."""
        data = block.encode("utf-8", "replace")
        alone = len(self.plain.compress(data))
        sizes = ((i, len(self.all[i][3].compress(data))) for i in (range(len(self.all)) if of is None else of))
        return sorted(((alone - n, 1 - n / alone, i) for i, n in sizes), key=lambda x: (-x[0], x[2]))

    def match(self, block: str) -> list[tuple]:
        """``name, saved, reduction, start, end, missing, extra`` of what the block is confirmed to hold."""
        if block not in self.done:
            if len(self.done) > 20_000:
                self.done.clear()
            self.done[block] = self._match(block)
        return self.done[block]

    def _match(self, block: str) -> list[tuple]:
        found = normal_words(block)
        have = [w for w, _, _ in found]
        possible = self.possible(set(have))
        out: list[tuple] = []
        for saved, reduction, i in self.ranked(block, possible) if possible else ():
            if saved <= 0:
                break
            hit = self._confirmed(i, have)
            if hit:
                low, high, missing, extra = hit
                a, b = found[low][1], found[high - 1][2]
                if all(b <= x[3] or a >= x[4] for x in out):
                    out.append((self.all[i][0], saved, reduction, a, b, missing, extra))
        return out

    def _confirmed(self, i: int, have: list[str]):
        """Span in words and exact differences where a block has the wording of a template."""
        words = self.all[i][2]
        runs = [m for m in difflib.SequenceMatcher(None, words, have, autojunk=False).get_matching_blocks() if m.size]
        if sum(m.size for m in runs) < LEAST * len(words):
            return None
        low, high = runs[0].b, runs[-1].b + runs[-1].size
        if high - low > 1.3 * len(words) + 2:
            return None
        same_a = {k for m in runs for k in range(m.a, m.a + m.size)}
        same_b = {k for m in runs for k in range(m.b, m.b + m.size)}
        missing = [w for k, w in enumerate(words) if k not in same_a]
        extra = [have[k] for k in range(low, high) if k not in same_b]
        if any(w in _DECISIVE or any(c.isdigit() for c in w) for w in missing + extra):
            return None
        return low, high, " ".join(missing), " ".join(extra)


def _section(text: str, a: int, b: int, low: int, high: int) -> tuple[int, int]:
    """The paragraph from ``a`` to ``b`` and its neighbours as long as they hold a cue."""
    while a > low:
        end = a - 2
        start = text.rfind("\n\n", low, end)
        start = low if start < 0 else start + 2
        if start >= end or not _CUE.search(text, start, end):
            break
        a = start
    while b < high:
        start = b + 2
        end = text.find("\n\n", start, high)
        end = high if end < 0 else end
        if start >= end or not _CUE.search(text, start, end):
            break
        b = end
    return a, b


def blocks(text: str) -> set[tuple[int, int]]:
    """Spans of the sentences, lines, paragraphs and runs of paragraphs that hold a cue."""
    out = set()
    for m in _CUE.finditer(text):
        low, high = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        for part in ("\n\n", "\n"):
            a, b = text.rfind(part, low, m.start()), text.find(part, m.end(), high)
            a, b = (low if a < 0 else a + len(part)), (high if b < 0 else b)
            out.add((a, b))
            if part == "\n\n":
                out.add(_section(text, a, b, low, high))
        at = a
        for cut in _SENTENCE.finditer(text, a, b):
            if cut.start() >= m.end():
                out.add((at, cut.start()))
                break
            if cut.end() <= m.start():
                at = cut.end()
        else:
            out.add((at, b))
    return out


def scan_text(text: str | None, templates: Templates) -> list[tuple]:
    """Findings of a text, ``name, start, end, reduction, missing, extra`` by place."""
    low = text.lower() if text else ""
    if not any(c in low for c in CUES):
        return []
    found = []
    for a, b in blocks(text):
        for name, saved, reduction, x, y, missing, extra in templates.match(text[a:b]):
            found.append((-saved, a + x, a + y, name, reduction, missing, extra))
    kept: list[tuple] = []
    for _, x, y, name, reduction, missing, extra in sorted(found):
        if all(y <= k[1] or x >= k[2] for k in kept):
            kept.append((name, x, y, reduction, missing, extra))
    return sorted(kept, key=lambda k: k[1:3])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, license, start, end, reduction, missing, extra, exact`` per finding."""

    def body(batches):
        templates = Templates()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.bool_())
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for name, a, b, reduction, missing, extra in scan_text(text, templates):
                    for x, v in zip(out, (doc_id, name, a, b, round(reduction, 6), missing, extra, not missing and not extra), strict=True):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["doc_id", "license", "start", "end", "reduction", "missing", "extra", "exact"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(body, "doc_id long, license string, start long, end long, reduction double, missing string, extra string, exact boolean")
