"""Secret scans by grammar inference: probabilistic automata of credential formats score every candidate.

Base patterns find credentials by their surroundings or alphabet; they are the labelled examples.
The states of an automaton for each kind are inferred by state merging (``automata``), over classes of
characters, and those of another one for ordinary strings; a bounded number of strings is enough to tell states
apart (``SAMPLE`` of a kind of at most ``LONGEST`` characters, by hash). Their probabilities are counted over all
different strings of half the hashes. A candidate is any run of 12 or more of the characters that
credentials are made of, or what base matches leave of it, without the signs that joined them. It is a secret if its likelihood per character under a credential
format is one that labelled credentials have, and exceeds that under the ordinary one by a
margin, half way between the two, that ordinary strings do not reach (but for the highest fiftieth of them: there are secrets
among unlabelled strings, too). Both limits are set on all different strings of the other half of
the hashes. Base matches always stay.

Defined cases: null text is empty; without labelled examples only base matches are found;
repeated rows get equal results; other columns are ignored. Places are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.llm.automata import Automaton
from gradeweave.llm.textnum import LOWER, blocks, byte_set, range_hashes, runs

KINDS = ["assign", "access", "hex", "inferred"]
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
# The words one of which an assignment begins with.
NAMES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
LEAST = {"assign": 12, "hex": 16, "inferred": 12}
SAMPLE, LONGEST = 400, 256
# Limits are found to this part of a unit of log likelihood per character.
BINS = 1024

_HEX = byte_set(b"0123456789abcdef")
_TOKEN = byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_JOINS = byte_set(b"/=._-")
_CLASS = np.zeros(256, np.int64)  # character classes: hexadecimal letters apart, each sign its own
for _i, _members in enumerate((b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ", b"+", b"/", b"_", b".", b"=", b"-")):
    _CLASS[list(_members)] = _i
CLASSES = 11


@dataclass
class Formats:
    secret: list[Automaton]
    ordinary: Automaton
    margin: float = 0.0
    least: float = 0.0

    def likelihoods(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihoods per character: under the best credential format, and how much that is above the ordinary one."""
        size = ends - starts
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
        return self.class_likelihoods(_CLASS[data[at]], offsets)

    def class_likelihoods(self, classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(offsets)
        best = np.max([a.scores(classes, offsets) for a in self.secret], axis=0)
        return best / np.maximum(size, 1), (best - self.ordinary.scores(classes, offsets)) / np.maximum(size, 1)

    def are_secrets(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own, ratio = self.likelihoods(data, starts, ends)
        return (own >= self.least) & (ratio > self.margin)


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of base matches in a block, byte places, in order."""
    found = [(int(a), 2, int(b), int(a)) for a, b in zip(*runs(_HEX[data], offsets)) if b - a >= LEAST["hex"]]
    whole, lowered = data.tobytes(), LOWER[data].tobytes()
    for d in _documents_with(whole, [b"AKIA"], offsets):
        a, b = offsets[d], offsets[d + 1]
        found += [(int(a) + m.start(), 1, int(a) + m.end(), int(a) + m.start()) for m in ACCESS.finditer(whole[a:b])]
    for d in _documents_with(lowered, NAMES, offsets):
        a, b = offsets[d], offsets[d + 1]
        found += [(int(a) + m.start(), 0, int(a) + m.end(), int(a) + m.start(2)) for m in ASSIGN.finditer(whole[a:b]) if m.end(2) - m.start(2) >= LEAST["assign"]]
    return sorted(found)


def _documents_with(text: bytes, words: list[bytes], offsets: np.ndarray) -> list[int]:
    """Documents in which one of the words may begin."""
    places = []
    for w in words:
        at = text.find(w)
        while at >= 0:
            places.append(at)
            at = text.find(w, at + 1)
    return np.unique(np.searchsorted(offsets, places, "right") - 1).tolist()


def candidates(data: np.ndarray, offsets: np.ndarray, base: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of credential characters, and the pieces that base matches leave of the runs they touch."""
    starts, ends = runs(_TOKEN[data], offsets)
    long = ends - starts >= LEAST["inferred"]
    starts, ends = starts[long], ends[long]
    if base:
        # spans of one kind do not overlap; merged over kinds they are sorted by both ends
        low, high = np.array([(s[0], s[2]) for s in base]).T
        high = np.maximum.accumulate(high)
        k = np.searchsorted(low, ends, "left") - 1
        clear = (k < 0) | (high[np.maximum(k, 0)] <= starts)
        pieces = [p for a, b in zip(starts[~clear].tolist(), ends[~clear].tolist()) for p in _pieces(data, a, b, low, high)]
        if pieces:
            more = np.array(pieces, np.int64)
            starts, ends = np.append(starts[clear], more[:, 0]), np.append(ends[clear], more[:, 1])
            order = np.argsort(starts)
            starts, ends = starts[order], ends[order]
        else:
            starts, ends = starts[clear], ends[clear]
    return starts, ends


def _pieces(data: np.ndarray, start: int, end: int, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
    """What base spans (merged ends in ``high``) leave of a run, cut back to where a joining sign ends, if long enough."""
    first = int(np.searchsorted(high, start, "right"))
    last = int(np.searchsorted(low, end, "left"))
    at = start
    for a, b in [*zip(low[first:last].tolist(), high[first:last].tolist()), (end, end)]:
        left, right = at, min(a, end)
        while left < right and left > start and _JOINS[data[left]]:
            left += 1
        while left < right and right < end and _JOINS[data[right - 1]]:
            right -= 1
        if right - left >= LEAST["inferred"]:
            yield left, right
        at = max(at, b)


def _least(found: dict[int, bytes], data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sample: int) -> dict[int, bytes]:
    """``found`` (string by hash) with those ranges of ``data``, cut to the ``sample`` least hashes."""
    short = ends - starts <= LONGEST
    starts, ends = starts[short], ends[short]
    hashes, first = np.unique(range_hashes(data, starts, ends).astype(np.int64), return_index=True)
    more = {h: data[starts[i] : ends[i]].tobytes() for h, i in zip(hashes[:sample].tolist(), first[:sample])}
    return dict(sorted((found | more).items())[:sample])


def _examples(sample: int):
    """Of each kind of labelled string (0 to 2) and of ordinary ones (3), the ``sample`` of the least hashes of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[dict[int, bytes]] = [{} for _ in KINDS]
        for _, data, offsets in blocks(batches):
            base = base_spans(data, offsets)
            for kind in range(3):
                own = np.array([(at, end) for _, k, end, at in base if k == kind], np.int64).reshape(-1, 2)
                least[kind] = _least(least[kind], data, own[:, 0], own[:, 1], sample)
            least[3] = _least(least[3], data, *candidates(data, offsets, base), sample)
        for kind, found in enumerate(least):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), kind, np.int32)), pa.array(list(found.values()), pa.binary()),
                                              pa.array(list(found), pa.int64())], names=["kind", "value", "hash"])

    return run


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind (as in ``_examples``), hash and character classes of every string of each block, once. Not the strings themselves."""
    for _, data, offsets in blocks(batches):
        base = base_spans(data, offsets)
        ranges = [np.array([(at, end) for _, k, end, at in base if k == kind], np.int64).reshape(-1, 2).T for kind in range(3)]
        for kind, (starts, ends) in enumerate([*ranges, candidates(data, offsets, base)]):
            hashes, first = np.unique(range_hashes(data, starts, ends).astype(np.int64), return_index=True)
            starts, ends = starts[first], ends[first]
            places = np.concatenate([[0], np.cumsum(ends - starts)])
            classes = _CLASS[data[np.arange(places[-1]) + np.repeat(starts - places[:-1], ends - starts)]].astype(np.uint8)
            held = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(classes)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), kind, np.int32)), pa.array(hashes), held], names=["kind", "hash", "classes"])


def _by_kind(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """kind, classes and offsets of all strings of a kind in a block."""
    for batch, data, offsets in blocks(batches, "classes"):
        kinds = batch.column(0).to_numpy()
        for kind in np.unique(kinds).tolist():
            own = np.flatnonzero(kinds == kind)
            sizes = (offsets[1:] - offsets[:-1])[own]
            places = np.concatenate([[0], np.cumsum(sizes)])
            yield kind, data[np.arange(places[-1]) + np.repeat(offsets[own] - places[:-1], sizes)].astype(np.int64), places


def _visits(automata: dict[int, Automaton]):
    """kind, cell of its table of visits, n: how often all strings of a task pass there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for kind, classes, offsets in _by_kind(batches):
            if kind in automata:
                total[kind] = total.get(kind, 0) + automata[kind].visits(classes, offsets)
        for kind, found in total.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(found.ravel()[at])], names=["kind", "at", "n"])

    return run


def _levels(formats: Formats):
    """kind (0: own likelihoods of credentials, 1: their ratios, 2: ratios of ordinary strings), bin, n: all strings of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[Counter] = [Counter(), Counter(), Counter()]
        for kind, classes, offsets in _by_kind(batches):
            own, ratio = formats.class_likelihoods(classes, offsets)
            for which, values in [(2, ratio)] if kind == 3 else [(0, own), (1, ratio)]:
                at, n = np.unique(np.floor(values * BINS).astype(np.int64), return_counts=True)
                total[which].update(dict(zip(at.tolist(), n.tolist())))
        for which, found in enumerate(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), which, np.int32)), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                             names=["kind", "at", "n"])

    return run


def _summed(strings: DataFrame, run) -> dict[int, dict[int, int]]:
    """n by kind and place, over all tasks. The tables are as large as an automaton or the range of likelihoods, whatever the input."""
    found: dict[int, dict[int, int]] = {}
    for r in strings.mapInArrow(run, "kind int, at bigint, n bigint").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r.kind, {})[r["at"]] = r.n
    return found


def _quantile(bins: dict[int, int], share: float) -> int:
    """The bin that holds the value at this share of all."""
    at = np.array(sorted(bins), np.int64)
    below = np.cumsum([bins[i] for i in at.tolist()])
    return int(at[np.searchsorted(below, share * (below[-1] - 1), "right")])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats | None:
    """Automata of the credential kinds and of ordinary strings, with probabilities and limits from all strings.

    Only which states there are is found on ``sample`` different strings of each kind, which come to the driver. The
    probabilities are counts over every different string with an even hash, and both limits are quantiles, to a
    ``BINS``-th, over every one with an odd hash. Strings are not written to a table: each task passes on
    ``sample`` of a kind, and of all others only classes of characters.
    """
    texts = docs.select("text")
    least = texts.mapInArrow(_examples(sample), "kind int, value binary, hash bigint").distinct()
    place = F.row_number().over(Window.partitionBy("kind").orderBy("hash", "value"))
    by_kind: list[list[bytes]] = [[] for _ in KINDS]
    for r in least.withColumn("_place", place).where(F.col("_place") <= sample).orderBy("kind", "_place").collect():
        by_kind[r.kind].append(bytes(r.value))
    used = [[_CLASS[np.frombuffer(v, np.uint8)].tolist() for v in values[::2]] for values in by_kind]
    if not used[3] or not any(used[:3]):
        return None
    automata = {kind: Automaton(v, CLASSES) for kind, v in enumerate(used) if v}
    every = texts.mapInArrow(_strings, "kind int, hash bigint, classes binary").groupBy("kind", "hash").agg(F.min("classes").alias("classes"))
    every = every.persist(StorageLevel.DISK_ONLY)
    try:
        fit, held_out = every.where("hash % 2 = 0").select("kind", "classes"), every.where("hash % 2 != 0").select("kind", "classes")
        for kind, found in _summed(fit, _visits(automata)).items():
            table = np.zeros((len(automata[kind].next), CLASSES + 1), np.int64)
            table.ravel()[list(found)] = list(found.values())
            automata[kind].recount(table)
        formats = Formats([automata[kind] for kind in range(3) if kind in automata], automata[3])
        levels = _summed(held_out, _levels(formats))
    finally:
        every.unpersist()
    if len(levels) < 3:
        return None
    formats.least = _quantile(levels[0], 0.02) / BINS - 0.01
    high = (_quantile(levels[2], 0.98) + 1) / BINS
    formats.margin = max((high + _quantile(levels[1], 0.05) / BINS) / 2, high + 0.25, 0.25)
    return formats


def scan(docs: DataFrame, formats: Formats | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_inferred, base_sha256, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(formats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats = shared.value
        for batch, data, offsets in blocks(batches):
            n = len(batch)
            base = base_spans(data, offsets)
            found = [(a, k, b) for a, k, b, _ in base]
            if formats:
                starts, ends = candidates(data, offsets, base)
                if len(starts):
                    good = formats.are_secrets(data, starts, ends)
                    found += [(int(a), 3, int(b)) for a, b in zip(starts[good], ends[good])]
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            lines: list[list] = [[] for _ in range(n)]
            counts = np.zeros((4, n), np.int64)
            for a, k, b in sorted(found):
                d = int(np.searchsorted(offsets, a, "right") - 1)
                first = chars[offsets[d]]
                lines[d].append((k, f"{KINDS[k]}:{chars[a] - first}:{chars[b] - first}"))
                counts[k, d] += 1
            digest = [hashlib.sha256(",".join(x for k, x in own if k < 3).encode()).hexdigest() for own in lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in counts], pa.array(digest), pa.array([",".join(x for _, x in own) for own in lines], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_inferred", "base_sha256", "spans"])

    held = docs.select("doc_id", "text")
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_inferred bigint, base_sha256 string, spans string")


def secret_scan(docs: DataFrame) -> DataFrame:
    return scan(docs, learn(docs))
