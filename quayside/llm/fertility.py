"""Quality rules on words and lines, and on how a public vocabulary takes a text apart (tokenizer fertility).

A vocabulary that fits a text spends few tokens on it. Three measures over the pieces of its words - characters per
token, share of byte-fallback tokens, entropy of the tokens relative to its largest value - must lie in the band of the
text's script, and must not lie far outside the quartiles of the texts of its script and language.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import SPACES, stored, words

PIECES = "piece_bpe_32k.model"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
CACHED_WORDS, CACHED_CHARS = 120_000, 40


@dataclass(frozen=True)
class Band:
    """What is accepted, ends included. A text of fewer than ``enough`` tokens has no meaningful entropy."""
    chars_per_token: tuple[float, float]
    most_fallback: float
    least_entropy: float = 0.35
    enough: int = 32


# Outer bands by script, for the 32k vocabulary of mostly Latin text. They hold at every size of a table.
BANDS = {
    "latin": Band((1.25, 8.0), 0.10),
    "greek": Band((0.6, 6.0), 0.30),
    "cyrillic": Band((0.8, 7.0), 0.20),
    "semitic": Band((0.5, 6.0), 0.40),
    "east_asian": Band((0.3, 4.0), 0.85),
    "other": Band((0.2, 8.0), 0.98, 0.25),
}

# Texts of one script and language whose quartiles count; a measure is rejected when it lies more than ``FAR`` times the
# distance of the quartiles (at least ``WIDTH`` of the lower one) outside of them.
LEAST, FAR, WIDTH = 50, 2.0, 0.02
# So many byte-fallback tokens (two emoji) are no evidence, whatever their share of a short text.
FEW = 8
MEASURES = ("chars_per_token", "fallback_share", "token_entropy")
# Quartiles are read from exact counts of the measures in thousandths. A group has at most ``TOP`` of them.
GRAIN, TOP = 1000, 16_000
OCTAVES = 48

# First code points of ranges, with the script of the letters there; below the first it is Latin.
_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "semitic"),
    (0x0780, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, None), (0x2E80, "east_asian"), (0xA4D0, "other"),
    (0xAC00, "east_asian"), (0xD800, None), (0xF900, "east_asian"), (0xFB00, "latin"), (0xFB07, "other"),
    (0xFB1D, "semitic"), (0xFE00, None), (0xFE70, "semitic"), (0xFEFF, None), (0xFF66, "east_asian"),
    (0xFFE0, None), (0x10000, "other"), (0x1F000, None), (0x20000, "east_asian"), (0x40000, None),
)
_STARTS = np.array([r[0] for r in _RANGES])


def script_of(text: str) -> str:
    """The script that most code points above ASCII punctuation belong to; Latin if there are none."""
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters = points[(points >= 0xAA) | ((points | 32) - 97 < 26)]
    votes: Counter[str] = Counter()
    counts = np.bincount(np.searchsorted(_STARTS, letters, "right") - 1, minlength=len(_RANGES))
    for (_, script), n in zip(_RANGES, counts.tolist()):
        if script and n:
            votes[script] += n
    return max(votes, key=lambda s: (votes[s], s)) if votes else "latin"


class Pieces:
    """Token ids of words, the most recent ones remembered."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        is_byte = [self._model.is_byte(i) for i in range(self._model.get_piece_size())]
        self._bytes = frozenset(i for i, b in enumerate(is_byte) if b)
        self._recent: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def of(self, split: list[str]) -> list[tuple[int, ...]]:
        found = list(map(self._recent.get, split))
        unseen = [k for k, f in enumerate(found) if f is None]
        fresh = []
        for k in unseen:
            if (old := self._older.get(split[k])) is None:
                fresh.append(k)
            found[k] = old
        for k, ids in zip(fresh, self._model.encode([split[k] for k in fresh], num_threads=1) if fresh else []):
            found[k] = tuple(ids)
        for k in unseen:
            if len(split[k]) <= CACHED_CHARS:
                if len(self._recent) >= CACHED_WORDS:
                    self._recent, self._older = {}, self._recent
                self._recent[split[k]] = found[k]
        return found

    def measure(self, split: list[str], chars: int) -> tuple[float, float, float, int]:
        """Characters per token, share of byte-fallback tokens, relative entropy (0 to 1), number of tokens."""
        counts = Counter(chain.from_iterable(self.of(split)))
        n = counts.total()
        if not n:
            return 0.0, 0.0, 0.0, 0
        fallback = sum(counts[i] for i in counts.keys() & self._bytes) / n
        bits = math.log2(n) - sum(c * math.log2(c) for c in counts.values()) / n
        return chars / n, fallback, bits / math.log2(n) if n > 1 else 0.0, n


@lru_cache(maxsize=2)
def load(path: str | None = None) -> Pieces:
    return Pieces(path or public_tokenizers.path(PIECES))


def repeated_words(split: list[str]) -> int:
    """Words inside windows of five words that occur at least twice in the text, the first occurrence included."""
    windows = list(zip(*(split[k:] for k in range(WINDOW))))
    counts = set(windows)
    if len(counts) == len(windows):
        return 0
    times = Counter(windows)
    covered, total = 0, 0  # covered: the first position that no repeated window has reached yet
    for k, window in enumerate(windows):
        if times[window] > 1:
            total += k + WINDOW - max(covered, k)
            covered = k + WINDOW
    return total


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double, "
           "fallback_share double, token_entropy double")


def judge(text: str, pieces: Pieces, bands: dict[str, Band]) -> tuple:
    split = words(text)
    chars = sum(map(len, split))
    repeated = repeated_words(split)
    failed = len(split) < 10 or 100 * repeated > 20 * len(split)
    script = script_of(text)
    per_token, fallback, entropy, n = pieces.measure(split, chars)
    band = bands[script]
    within = (band.chars_per_token[0] <= per_token <= band.chars_per_token[1] and fallback <= band.most_fallback
              and (n < band.enough or entropy >= band.least_entropy))
    return (len(split), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated, failed,
            not failed and within, script, n, per_token, fallback, entropy)


def quartiles(measured: DataFrame) -> dict[tuple, dict[int, list[tuple[float, float]]]]:
    """Lower and upper quartile of each measure, per script and language, then per octave of the number of tokens (all
    octaves: -1). Of texts that pass the base rule those with equal figures, mostly copies, count once.
    """
    group = ["script", "lang", "octave"]
    seen = measured.filter("NOT base_failed").select("script", "lang", "n_words", "word_chars", "n_tokens", *MEASURES)
    bins = F.posexplode(F.array(*(F.least(F.round(F.col(m) * GRAIN), F.lit(TOP)).cast("int") for m in MEASURES)))
    counts = (seen.distinct().withColumn("octave", F.explode(F.array(_octave(), F.lit(-1))))
              .select(*group, bins.alias("measure", "bin")).groupBy(*group, "measure", "bin").count())
    whole = Window.partitionBy(*group, "measure")
    ranked = counts.select("*", F.sum("count").over(whole.orderBy("bin")).alias("upto"),
                           F.sum("count").over(whole).alias("of")).filter(F.col("of") >= LEAST)
    rows = ranked.groupBy(*group, "measure").agg(*(
        F.min(F.when(4 * F.col("upto") >= k * F.col("of"), F.col("bin"))).alias(f"q{k}") for k in (1, 3)))
    found: dict[tuple, dict[int, list]] = {}
    # As many rows as there are scripts, languages and octaves, three each.
    for r in rows.collect():
        place = found.setdefault((r.script, r.lang), {}).setdefault(r.octave, [None] * len(MEASURES))
        place[r.measure] = (r.q1 / GRAIN, r.q3 / GRAIN)
    return found


def _octave():
    return F.length(F.bin("n_tokens")) - 1


def fences(octaves: dict[int, list[tuple[float, float]]], octave: int) -> tuple[float, float, float | None]:
    """Least characters per token, largest fallback share and least entropy for texts of an octave.

    Short texts vary more, so the octave can lower the limit of all texts of the language, not raise it. Entropy falls
    with the number of tokens: an octave of too few texts has the (wider) quartiles of all.
    """
    def below(pair):
        return pair[0] - FAR * max(pair[1] - pair[0], WIDTH * pair[0])

    def above(pair):
        return pair[1] + FAR * max(pair[1] - pair[0], WIDTH)

    whole, own = octaves[-1], octaves.get(octave, octaves[-1])
    return (min(below(whole[0]), below(own[0])), max(above(whole[1]), above(own[1])), below(own[2]))


def fertility_rules(docs: DataFrame, bands: dict[str, Band] | None = None, path: str | None = None) -> DataFrame:
    """Counts, measures and verdict of every whole text.

    One row per row of the input, repeated rows and null ids included; ``lang``, where present, tells which texts are
    compared, other columns are ignored. A null or empty text has no words, zero counts and measures, and fails the
    base rule. ``bands`` replaces the outer bands of some scripts, ``path`` is the vocabulary on every executor. A
    script and language of fewer than ``LEAST`` texts has the outer band only.
    """
    limits = BANDS | (bands or {})

    def run(batches):
        pieces = load(path)
        schema = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _SCHEMA.split(", ")])
        for batch in batches:
            rows = [judge(t.as_py() or "", pieces, limits) for t in batch.column("text")]
            columns = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])),
                 batch.column("lang")], schema=schema.append(pa.field("lang", pa.string())))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang"))
    measured = stored(rows.mapInArrow(run, f"{_SCHEMA}, lang string"))
    enough = {script: band.enough for script, band in limits.items()}
    places = [(script, lang, octave, enough[script], *fences(octaves, octave))
              for (script, lang), octaves in quartiles(measured).items() if -1 in octaves for octave in range(OCTAVES)]
    near = docs.sparkSession.createDataFrame(
        places, "script string, lang string, octave int, enough int, least_chars double, most_fallback double, "
        "least_entropy double").withColumnsRenamed({"script": "of_script", "lang": "of_lang"})
    n = F.col("n_tokens")
    within = ((F.col("chars_per_token") >= F.col("least_chars"))
              & ((F.col("fallback_share") <= F.col("most_fallback"))
                 | (F.round(F.col("fallback_share") * n) <= FEW))
              & ((n < F.col("enough")) | (F.col("token_entropy") >= F.col("least_entropy"))))
    met = ((F.col("script") == F.col("of_script")) & F.col("lang").eqNullSafe(F.col("of_lang"))
           & (_octave() == F.col("octave")))
    # A few numbers per language.
    judged = measured.join(F.broadcast(near), met, "left")
    return judged.withColumn("kept", F.col("kept") & F.coalesce(within, F.lit(True))).select(
        *(c.split()[0] for c in _SCHEMA.split(", ")))


_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
