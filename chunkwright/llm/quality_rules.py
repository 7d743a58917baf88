"""Quality rules as a short-circuit cascade.

Every text gets its base counts. Texts that pass the base limits go through the rules of RULES one after another;
a rule sees only what all rules before it let through. The order comes from a bounded sample, the first SAMPLE_ROWS
texts that a task meets: each rule runs alone on it, and rules are sorted by rejected rows per second. So no second
pass, shuffle or message to the driver is needed for it. The order changes the work, never the verdict: a text is
kept if no rule rejects it, so a task that runs again may time its rules otherwise and still returns the same rows.

Words are runs of bytes other than 0x20 and 0x09-0x0D; lines are split at \\n. A null text has no words, so it
fails the base limits and isn't kept; so does an empty one. Texts of any length are read whole. doc_id may be null
or repeated: rows are judged one by one. An empty table gives an empty result. keep_quality passes all columns through,
whatever their names; quality_scores reads doc_id and text only.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chunkwright.llm import shared

SAMPLE_ROWS = 200
GROUP_BYTES = 4 << 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _pair_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return pd.factorize((a.astype(np.int64) << 32) | b)[0]


def repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text, how many of its words lie in a window of three words that the text has twice or more."""
    n = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(n.sum()), object)
    flat[:] = [x for w in words for x in w]
    if len(flat) < 3:
        return np.zeros(len(words), np.int64)
    ids, doc = pd.factorize(flat)[0], np.repeat(np.arange(len(words)), n)
    inside = doc[2:] == doc[:-2]
    window = _pair_ids(_pair_ids(_pair_ids(ids[:-2], ids[1:-1]), ids[2:]), doc[:-2])
    twice = inside & (np.bincount(window[inside], minlength=window.max() + 1)[window] > 1)
    covered = np.zeros(len(flat), bool)
    for k in range(3):
        covered[k : len(flat) - 2 + k] |= twice
    return np.bincount(doc[covered], minlength=len(words)).astype(np.int64)


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text; those that only rules use have a leading underscore."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - np.array([len(t) + 1 for t in texts])
    flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[flat]

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[ends] - total[starts]

    first = ~space
    first[1:] &= space[:-1]
    out = {"n_words": per_text(first), "word_chars": per_text(~space & ((flat & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[flat])}
    out |= {"_letters": per_text(_LETTER[flat] & ((flat & 0xC0) != 0x80)), "_upper": per_text(_UPPER[flat])}
    dup, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        seen: set[bytes] = set()
        for line in t.split(b"\n"):
            if line.strip(b" \t\n\r\v\f"):
                lines[i] += 1
                dup[i] += line in seen
                seen.add(line)
    return out | {"n_dup_lines": dup, "_lines": lines, "n_repeat_words": repeat_words([t.split() for t in texts])}


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def _lines_ending(texts: list[bytes], marks: tuple[bytes, ...], share: float) -> np.ndarray:
    cut = [t.split(b"\n") for t in texts]
    return np.array([sum(x.rstrip().endswith(marks) for x in lines) > share * len(lines) for lines in cut], bool)


def _wordlike(texts: list[bytes], least: float) -> np.ndarray:
    """True where less than that share of the words has a letter."""
    out = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        words = t.split()
        out[i] = sum(any(_LETTER[b] for b in w[:8]) or bool(_LETTER[np.frombuffer(w, np.uint8)].any()) for w in words) < least * len(words)
    return out


def _top_word(texts: list[bytes], share: float) -> np.ndarray:
    return np.array([bool(w := t.split()) and np.unique(pd.factorize(np.array(w, object))[0], return_counts=True)[1].max() > share * len(w) for t in texts], bool)


#: name -> (texts, their counts) -> rejected. All are over whole texts.
RULES: dict[str, Callable[[list[bytes], dict[str, np.ndarray]], np.ndarray]] = {
    "symbols_to_words": lambda t, c: 10 * c["n_symbols"] > c["n_words"],
    "word_length": lambda t, c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"]),
    "upper_case": lambda t, c: 2 * c["_upper"] > c["_letters"],
    "repeated_lines": lambda t, c: 10 * c["n_dup_lines"] > 6 * c["_lines"],
    "ellipsis_lines": lambda t, c: _lines_ending(t, (b"...", "…".encode()), 0.3),
    "wordlike": lambda t, c: _wordlike(t, 0.7),
    "top_word": lambda t, c: _top_word(t, 0.3),
}


def groups(texts: list[bytes], most: int = GROUP_BYTES) -> Iterator[slice]:
    """Runs of texts of about that many bytes; a longer text is a run of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    if texts:
        yield slice(at, len(texts))


class Cascade:
    """Rules in the order that its own first texts suggest."""

    def __init__(self, sample_rows: int = SAMPLE_ROWS):
        self.left, self.order = sample_rows, list(RULES)
        self.took, self.hits = dict.fromkeys(RULES, 1e-6), dict.fromkeys(RULES, 0.5)

    def _sample(self, texts: list[bytes], c: dict[str, np.ndarray]) -> None:
        for name, rule in RULES.items():
            began = time.perf_counter()
            self.hits[name] += int(np.sum(rule(texts, c)))
            self.took[name] += time.perf_counter() - began
        self.left -= len(texts)
        self.order = sorted(RULES, key=lambda r: -self.hits[r] / self.took[r])

    def _passed(self, texts: list[bytes], c: dict[str, np.ndarray]) -> np.ndarray:
        """Indexes of the texts that no rule rejects, of those that passed the base limits."""
        alive = np.flatnonzero(~base_failed(c))
        if self.left > 0 and len(alive):
            pick = alive[: self.left]
            self._sample([texts[i] for i in pick], {k: v[pick] for k, v in c.items()})
        for name in self.order:
            if not len(alive):
                break
            alive = alive[~RULES[name]([texts[i] for i in alive], {k: v[alive] for k, v in c.items()})]
        return alive

    def judge(self, texts: list[bytes | None]) -> dict[str, np.ndarray]:
        """Counts, base_failed and kept of each text."""
        whole, parts = [t or b"" for t in texts], []
        for run in groups(whole):
            c = base_counts(whole[run])
            kept = np.zeros(len(c["n_words"]), bool)
            kept[self._passed(whole[run], c)] = True
            parts.append({k: c[k] for k in COUNTS} | {"base_failed": base_failed(c), "kept": kept})
        return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (*COUNTS, "base_failed", "kept")}


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def quality_scores(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed and kept of every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.worker_memory("quality_rules")
        cascade = Cascade()
        for batch in shared.small_batches(batches):
            out = cascade.judge(_texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), *(pa.array(out[k], pa.int64()) for k in COUNTS), *(pa.array(out[k], pa.bool_()) for k in ("base_failed", "kept"))], names=["doc_id", *COUNTS, "base_failed", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {', '.join(f'{k} long' for k in COUNTS)}, base_failed boolean, kept boolean")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.worker_memory("quality_rules")
        cascade = Cascade()
        for batch in shared.small_batches(batches):
            yield batch.filter(pa.array(cascade.judge(_texts(batch))["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(shared.documents(spark, sf_dir))


QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLES: dict[str, str] = {}
