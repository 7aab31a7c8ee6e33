"""URL filter: host rules first, then the ratio of two character language models.

Rules name a host with all its subdomains and the start of a path; the longest that fits decides.
URLs that rules accept or reject are the examples of two variable-order Markov models of bytes,
smoothed from order ``ORDER`` down by Witten and Bell: a context that has been seen gives what
follows it as much weight as it has seen symbols, and its number of different symbols to the next
shorter context, down to even odds. Contexts of more than ``SURE_ORDER`` bytes seen only once are
left out. The difference of both log-likelihoods per byte is a URL's score.

A logistic curve, fitted to the scores of examples that were held out, turns it into the chance
that the URL is accepted, at even odds of both verdicts; the URL is allowed if that is half or more.

A model's examples are at most ``EXAMPLES`` different URLs of each verdict, those of least hash
among the ones of at most ``LONGEST`` bytes, and as many of these as come to ``EXAMPLE_BYTES``; each
``HELD_OUT``-th of them is held out. Everything else covers all rows.

Defined cases: a null URL, or one without ``://``, has empty host and path and is scored by its
bytes; the empty URL has score 0; without examples of a verdict its model has even odds, and the
curve stays the score's sign; ties are allowed; repeated rows are judged each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.textnum import blocks, mix64, utf8

#: Verdict, host, start of the path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
ORDER, SURE_ORDER = 5, 2
EXAMPLES, EXAMPLE_BYTES, LONGEST, HELD_OUT = 10_000, 1 << 20, 2048, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rules = Sequence[tuple[str, str, str]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to a slash, in lower case, and from there up to a query or fragment."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Rules = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = None
    for kind, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules: Rules = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict)."""
    parts = pages.select("page_id", "url").withColumns(dict(zip(("host", "path"), host_and_path(F.col("url")))))
    return parts.withColumns(dict(zip(("rule", "ruled"), fitting_rule(F.col("host"), F.col("path"), rules))))


@dataclass(frozen=True)
class Markov:
    """Counts by hash of context, and of context and symbol, for each order; sorted by hash."""

    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # hash, symbols seen, different symbols
    symbols: list[tuple[np.ndarray, np.ndarray]]  # hash, times seen

    def log_chances(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The natural logarithm of each byte's chance after those before it in its URL."""
        chance = np.full(len(data), 1 / 256)
        for (keys, seen, different), (pairs, times), (context, pair, there) in zip(self.contexts, self.symbols, _grams(data, offsets)):
            n, t = _found(keys, context, seen), _found(keys, context, different)
            c = _found(pairs, pair, times)
            chance = np.where(there & (n > 0), (c + t * chance) / np.maximum(n + t, 1), chance)
        return np.log(chance)


def _found(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0).astype(float)


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order and byte: the hash of the bytes before it, that with the byte itself, and whether so many stand before it."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    symbol = data.astype(np.uint64) + np.uint64(1)
    context = np.zeros(len(data), np.uint64)
    for order in range(ORDER + 1):
        if order:
            back = np.zeros(len(data), np.uint64)
            back[order:] = symbol[: len(data) - order] if order < len(data) else symbol[:0]
            context = mix64(context * np.uint64(257) + back)
        yield context, mix64(context * np.uint64(263) + symbol + np.uint64(300)), place >= order


def learned(urls: pa.Array) -> Markov:
    """The model of these URLs."""
    data, offsets = utf8(urls)
    contexts, symbols = [], []
    for order, (context, pair, there) in enumerate(_grams(data, offsets)):
        context, pair = context[there], pair[there]
        pairs, first, times = np.unique(pair, return_index=True, return_counts=True)
        keys, different = np.unique(context[first], return_counts=True)
        seen = np.zeros(len(keys), np.int64)
        np.add.at(seen, np.searchsorted(keys, context[first]), times)
        if order > SURE_ORDER:
            sure = seen > 1
            held = sure[np.searchsorted(keys, context[first])]
            keys, different, seen, pairs, times = keys[sure], different[sure], seen[sure], pairs[held], times[held]
        contexts.append((keys, seen, different))
        symbols.append((pairs, times))
    return Markov(contexts, symbols)


@dataclass(frozen=True)
class Filter:
    """Both models and the curve: the chance is 1 / (1 + exp(-(slope * score + offset)))."""

    accepted: Markov
    rejected: Markov
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Difference of the log-likelihoods per byte of each URL."""
        difference = np.concatenate([[0.0], np.cumsum(self.accepted.log_chances(data, offsets) - self.rejected.log_chances(data, offsets))])
        return (difference[offsets[1:]] - difference[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    def chances(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.offset, -700, 700)))


def calibrated(accepted: np.ndarray, rejected: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of held-out scores, both verdicts weighing the same; Newton's method with a small ridge."""
    if not len(accepted) or not len(rejected):
        return 1.0, 0.0
    x = np.concatenate([accepted, rejected])
    spread = x.std() or 1.0
    x = np.column_stack([x / spread, np.ones(len(x))])
    y = np.concatenate([np.ones(len(accepted)), np.zeros(len(rejected))])
    weight = np.concatenate([np.full(len(accepted), 0.5 / len(accepted)), np.full(len(rejected), 0.5 / len(rejected))])
    beta, ridge = np.zeros(2), 1e-3 * np.eye(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -700, 700)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-12:
            break
    # a curve that falls would turn the ratio round: then the score's own sign decides
    return (float(beta[0] / spread), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def _examples(ruled: DataFrame, verdict: str) -> pa.Array:
    """Different URLs of a verdict, in the order of their hashes, at most EXAMPLES and EXAMPLE_BYTES."""
    urls = ruled.where((F.col("ruled") == verdict) & (F.octet_length("url") <= LONGEST)).select("url").distinct()
    found = urls.orderBy(F.xxhash64("url"), "url").limit(EXAMPLES).toArrow().column("url").combine_chunks()
    return found.slice(0, int(np.searchsorted(utf8(found)[1][1:], EXAMPLE_BYTES, "right")))


def trained(ruled: DataFrame) -> Filter:
    """Models and curve from the URLs that rules have judged."""
    urls = {v: _examples(ruled, v) for v in ("allow", "block")}
    held = {v: np.arange(len(u)) % HELD_OUT == HELD_OUT - 1 for v, u in urls.items()}
    models = {v: learned(u.filter(pa.array(~held[v], pa.bool_()))) for v, u in urls.items()}
    plain = Filter(models["allow"], models["block"])
    curve = calibrated(*[plain.scores(*utf8(u.filter(pa.array(held[v], pa.bool_())))) for v, u in urls.items()])
    return Filter(models["allow"], models["block"], *curve)


def url_filter(pages: DataFrame, rules: Rules = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and for URLs without a rule the score and the chance that they are accepted."""
    ruled = judged_by_rules(pages, rules)
    # learned from at most 2 * EXAMPLE_BYTES, so its size is bounded
    model = pages.sparkSession.sparkContext.broadcast(trained(ruled))
    kinds = dict(ruled.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, "url", 1 << 18):
            ruling = batch.column(5)
            free = np.asarray(ruling.is_null())
            lengths = np.diff(offsets) * free
            score = model.value.scores(data[np.repeat(free, np.diff(offsets))], np.concatenate([[0], np.cumsum(lengths)]))
            chance = model.value.chances(score)
            verdict = np.where(free, np.where(chance >= 0.5, "allow", "block"), np.array(ruling.to_pylist(), object))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(verdict, pa.string()),
                 pa.array(score, pa.float64(), mask=~free), pa.array(chance, pa.float64(), mask=~free)],
                names=["page_id", "host", "path", "rule", "verdict", "score", "chance"])

    return ruled.mapInArrow(run, f"page_id {kinds['page_id']}, host string, path string, rule string, verdict string, score double, chance double")
