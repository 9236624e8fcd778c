"""Quality by tokeniser fertility: what a public vocabulary makes of a text's words.

Each word is encoded by a piece vocabulary with byte fallback. Per document this gives characters per token, the share of tokens that are
fallback bytes, and the entropy of its tokens; bands per language (per script where the language is null) reject what the vocabulary serves far
worse than the rest of its group. A band's centre and spread are quartiles over all documents of the group that pass the base rules,
and the allowed distance shrinks with the square root of the token count, so short texts are not rejected for chance.

Cases: a null text has no words, so it fails the base rules (fewer than 20 words), as an empty one does; repeated rows are judged alike; a
null language falls to its script, texts without letters to ``none``; a group whose documents all look alike gets the least spread;
an empty table gives an empty one. Extra columns pass through ``filtered``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import prepare, runs, stored, text_of
from tidewatch.llm.vocab import ODD, Memo, from_pieces, loaded, read_file, vocabulary_path

PIECES = "piece_bpe_32k.model"
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: White space that is no word boundary here, though Python's split takes it for one.
NOT_A_BREAK = [c for c in ODD if c not in "\t\r\x0b\x0c"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: Distance from the group's median, in spreads, that is still accepted, and the least spread (characters per token of one token).
REACH, LEAST_SPREAD = 4.0, 0.25
#: Fallback bytes accepted on top of three times the group's upper quartile; share of the group's usual entropy that is required.
FALLBACK_SLACK, ENTROPY_SHARE = 0.05, 0.5
#: First and last code points of scripts by their main blocks.
SCRIPTS = {
    "latin": (0x41, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F), "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x77F),
    "indic": (0x900, 0xDFF), "thai": (0xE00, 0xE7F), "hangul": (0xAC00, 0xD7AF), "kana": (0x3040, 0x30FF), "han": (0x3400, 0x9FFF),
}


class Fertility:
    def __init__(self, processor):
        self.memo = Memo(processor.encode, limit=200_000)
        self.is_byte = np.array([processor.is_byte(i) for i in range(processor.get_piece_size())])

    def measure(self, texts: list[str]) -> dict[str, np.ndarray]:
        parts = [self._measure(run) for run in runs(texts)] or [self._measure([])]
        return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}

    def _measure(self, texts: list[str]) -> dict[str, np.ndarray]:
        words: list[str] = []
        ends, symbols, dup_lines, chars = [], [], [], []
        for text in texts:
            own = WORDS.findall(text) if any(c in text for c in NOT_A_BREAK) else text.split()
            words += own
            ends.append(len(words))
            chars.append(sum(map(len, own)))
            symbols.append(sum(map(text.count, SYMBOLS)))
            lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
            dup_lines.append(len(lines) - len(set(lines)))
        ends = np.array([0, *ends], np.int64)
        n_words = np.diff(ends)
        doc = np.repeat(np.arange(len(texts)), n_words)
        codes = self.memo.look_up(words)
        repeated = repeated_words(codes, doc)
        counts = self.memo.counts(codes)
        ids = self.memo.ids(codes)
        token_doc = np.repeat(doc, counts)
        per_doc = lambda x, where: np.bincount(where, weights=x, minlength=len(texts))
        n_tokens = per_doc(counts, doc)
        keys, times = np.unique((token_doc << 32) | ids, return_counts=True)
        of = keys >> 32
        share = times / n_tokens[of]
        return {
            "n_words": n_words, "word_chars": np.array(chars, np.int64), "n_symbols": np.array(symbols, np.int64),
            "n_dup_lines": np.array(dup_lines, np.int64), "n_repeat_words": per_doc(repeated, doc).astype(np.int64),
            "n_tokens": n_tokens.astype(np.int64), "n_fallback": per_doc(self.is_byte[ids], token_doc).astype(np.int64),
            "entropy": per_doc(-share * np.log2(share), of),
        }


def repeated_words(codes: np.ndarray, doc: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Whether each word lies in a window of ``size`` words that its text holds twice or more."""
    n = len(codes) - size + 1
    covered = np.zeros(len(codes) + 1, np.int64)
    if n > 1:
        key = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for j in range(size):
            key = (key ^ codes[j:j + n].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
        at = np.flatnonzero(doc[:n] == doc[size - 1:])
        at = at[np.argsort(key[at], kind="stable")]
        a, b = at[:-1], at[1:]
        same = key[a] == key[b]
        a, b = a[same], b[same]
        same = doc[a] == doc[b]  # equal hashes are compared word by word
        for j in range(size):
            same &= codes[a + j] == codes[b + j]
        found = np.unique(np.concatenate([a[same], b[same]]))
        covered[found] += 1
        np.subtract.at(covered, found + size, 1)
    return np.cumsum(covered)[:-1] > 0


def piece_fertility(data: bytes) -> Fertility:
    return Fertility(from_pieces(data))


def script_of(text: str) -> str:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = {name: int(((points >= low) & (points <= high)).sum()) for name, (low, high) in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "none"


MEASURES = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
            "n_tokens": "bigint", "n_fallback": "bigint", "entropy": "double"}


def measured(frame: DataFrame, text: str = "text", lang: str = "lang", path: str | None = None) -> DataFrame:
    """``frame`` with a struct ``__m`` of the measures and ``__group``."""
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(read_file(path or vocabulary_path(PIECES)))

    @F.arrow_udf("struct<" + ",".join(f"{k}:{v}" for k, v in MEASURES.items()) + ">")
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = loaded(piece_fertility, shared.value).measure(batch.to_pylist())
            types = [pa.float64() if v == "double" else pa.int64() for v in MEASURES.values()]
            yield pa.StructArray.from_arrays([pa.array(found[k], t) for k, t in zip(MEASURES, types)], list(MEASURES))

    @F.arrow_udf("string")
    def script(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([t if t is None else script_of(t) for t in batch.to_pylist()], pa.string())

    group = F.coalesce(F.col(lang), script(F.when(F.col(lang).isNull(), text_of(text))))
    return frame.withColumns({"__m": measure(text_of(text)), "__group": group})


def base_failed(m: str = "__m"):
    words, repeated = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def _quartiles(rows: DataFrame, value: str, step: float) -> DataFrame:
    """Per ``__group``, ``low``, ``mid`` and ``high`` quartile of ``value`` in whole steps: exact, from counts per step."""
    counts = rows.groupBy("__group", F.round(F.col(value) / step).cast("long").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    # Rows here are steps of a group, not documents.
    up_to = Window.partitionBy("__group").orderBy("at")
    summed = counts.select("__group", "at", F.sum("n").over(up_to).alias("sum"), F.sum("n").over(Window.partitionBy("__group")).alias("all"))
    first = lambda share: F.min(F.when(F.col("sum") >= share * F.col("all"), F.col("at"))) * step
    return summed.groupBy("__group").agg(first(0.25).alias("low"), first(0.5).alias("mid"), first(0.75).alias("high"))


def bands(measures: DataFrame) -> DataFrame:
    """Per ``__group``: ``centre`` and ``spread`` of characters per token (of one token), ``most_fallback``, ``least_entropy``."""
    tokens = F.greatest(F.col("__m.n_tokens"), F.lit(1))
    rows = measures.where(~base_failed()).select(
        "__group", (F.col("__m.word_chars") / tokens).alias("fertility"), tokens.alias("n"),
        (F.col("__m.n_fallback") / tokens).alias("fallback"), F.col("__m.entropy").alias("entropy"),
    )
    rows = stored(rows, "fertility")
    centre = stored(_quartiles(rows, "fertility", 0.005).select("__group", F.col("mid").alias("centre")), "centres")
    away = rows.join(centre, "__group").withColumn("away", (F.col("fertility") - F.col("centre")) * F.sqrt("n"))
    spread = _quartiles(away, "away", 0.01).select("__group", F.greatest((F.col("high") - F.col("low")) / 1.349, F.lit(LEAST_SPREAD)).alias("spread"))
    fallback = _quartiles(rows, "fallback", 0.001).select("__group", (3 * F.col("high") + FALLBACK_SLACK).alias("most_fallback"))
    entropy = _quartiles(rows, "entropy", 0.01).select("__group", (ENTROPY_SHARE * F.col("mid")).alias("least_entropy"))
    return stored(centre.join(spread, "__group").join(fallback, "__group").join(entropy, "__group"), "bands")


def judged(measures: DataFrame) -> DataFrame:
    """``measures`` with ``__failed`` (base rules) and ``__kept``. The bands are stored, so the planner knows their size and broadcasts them if small."""
    m = lambda name: F.col(f"__m.{name}")
    tokens = F.greatest(m("n_tokens"), F.lit(1))
    limits = bands(measures).select(F.col("__group").alias("__of"), F.struct("centre", "spread", "most_fallback", "least_entropy").alias("__band"))
    fertile = m("word_chars") / tokens >= F.col("__band.centre") - REACH * F.col("__band.spread") / F.sqrt(tokens)
    varied = m("entropy") >= F.least("__band.least_entropy", ENTROPY_SHARE * F.log2(tokens.cast("double")))
    good = fertile & (m("n_fallback") / tokens <= F.col("__band.most_fallback")) & varied
    joined = measures.join(limits, F.col("__group") == F.col("__of"), "left").withColumn("__failed", base_failed())
    return joined.withColumn("__kept", ~F.col("__failed") & F.coalesce(good, F.lit(True)))


def report(frame: DataFrame) -> DataFrame:
    """Per document the base measures, ``base_failed``, ``kept`` and the fertility measures."""
    rows = judged(stored(measured(frame.select("doc_id", "text", "lang")).drop("text", "lang"), "measures"))
    m = lambda name: F.col(f"__m.{name}").alias(name)
    return rows.select(
        "doc_id", *[m(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"), m("n_tokens"), m("n_fallback"), m("entropy"),
    )


def filtered(frame: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``frame``; they are measured once and stored with their measures in between."""
    return judged(stored(measured(frame), "measures")).where("__kept").select(*[F.col(f"`{c}`") for c in frame.columns])
