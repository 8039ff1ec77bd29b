"""Language identification by bit-sliced Bloom filters whose slots hold a bit per language.

One lookup of an n-gram returns the set of all languages that contain it. A text's n-grams vote: per language the hits
are counted, the hits that the filter's false positives explain are taken away, and the largest share wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import remainder, stored

GRAM = 4                # code points of an n-gram, word boundaries included
LEAST_SHARE = 2e-5      # of a language's n-grams; so a language has at most 50,000
RELATIVE = 0.25         # of the largest share that any language gives the n-gram
BITS, HASHES = 16, 3    # filter slots per n-gram, slots per lookup
FOLDS, HELD_OUT = 4, 2
BLOCK = 1 << 20         # code points handled at once
_FLUSH = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ALPHA = np.array([chr(c).isalpha() for c in range(0x30000)])


def grams(text: str) -> np.ndarray:
    """A 64-bit hash of each n-gram of lower-cased letters; a run of anything else is one blank. No letter, no gram."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _ALPHA[np.minimum(points, len(_ALPHA) - 1)]
    if not letter.any():
        return np.zeros(0, np.uint64)
    plain = np.where(letter, points, 32).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters, the first stays as the blank
    plain = np.concatenate([[32], plain[keep], [32]]).astype(np.uint64)
    plain = np.concatenate([plain, np.full(max(0, GRAM - len(plain)), 32, np.uint64)])
    code = np.zeros(len(plain) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        code = (code ^ plain[k:len(plain) - GRAM + 1 + k]) * _MIX
        code ^= code >> np.uint64(29)
    return code


def blocks(text: str):
    """The n-grams of a whole text, a block of characters at a time."""
    for k in range(0, len(text), BLOCK):
        yield grams(text[max(0, k - GRAM + 1):k + BLOCK] if k else text[:BLOCK])


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray           # (words, slots) of 64-bit language masks
    false_positive: np.ndarray  # per language, the share of foreign n-grams that hit by chance

    def masks(self, code: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram: the slots of all hashes, combined by AND."""
        size, found = np.uint64(self.slots.shape[1]), None
        other = (code >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            hit = self.slots[:, (code + np.uint64(k) * other) % size]
            found = hit if found is None else found & hit
        return found

    def hits(self, text: str) -> tuple[np.ndarray, int]:
        """The corrected number of hits of each language, and the number of n-grams."""
        n, raw = 0, np.zeros(len(self.languages))
        for code in blocks(text):
            found = self.masks(code)
            n += len(code)
            for j in range(len(raw)):
                raw[j] += np.count_nonzero((found[j // 64] >> np.uint64(j % 64)) & np.uint64(1))
        f = self.false_positive
        return np.maximum(raw - n * f, 0) / (1 - f), n

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with most hits (ties: the first in alphabetical order) and its margin over the next, 0 to 1."""
        hits, n = self.hits(text) if text else (np.zeros(0), 0)
        if not n or not len(hits):
            return "und", 0.0
        best = int(hits.argmax())
        rest = float(np.delete(hits, best).max()) if len(hits) > 1 else 0.0
        top = float(hits[best])
        return self.languages[best], (0.5 * top / n + 0.5 * (top - rest) / top if top else 0.0)


def build(counts: pd.DataFrame) -> LanguageFilter:
    """The filter over rows of language, n-gram and share."""
    languages = sorted(counts["lang"].unique())
    size = max(64, BITS * int(counts["gram"].nunique()))
    slots = np.zeros((-(-len(languages) // 64), size), np.uint64)
    code = counts["gram"].to_numpy().astype(np.int64).view(np.uint64)
    number = counts["lang"].map({l: j for j, l in enumerate(languages)}).to_numpy()
    other = (code >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        at = (code + np.uint64(k) * other) % np.uint64(size)
        for j in range(len(languages)):
            slots[j // 64, at[number == j]] |= np.uint64(1) << np.uint64(j % 64)
    filled = np.array([np.mean((slots[j // 64] >> np.uint64(j % 64)) & np.uint64(1)) for j in range(len(languages))])
    return LanguageFilter(languages, slots, np.minimum(filled**HASHES, 0.99))


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n``: counts over all given documents, added up in each task before the shuffle."""
    def run(frames):
        pending: dict[str, list[np.ndarray]] = {}
        held = 0

        def flush():
            for lang, parts in pending.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})
            pending.clear()

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                for code in blocks(text):
                    pending.setdefault(lang, []).append(code)
                    held += len(code)
                    if held >= _FLUSH:
                        yield from flush()
                        held = 0
        yield from flush()

    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return rows.mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> LanguageFilter | None:
    """Learn from the documents outside the held-out fold that have a language; None if there are none.

    All of them are counted. An n-gram belongs to a language if it makes up ``LEAST_SHARE`` of the language's n-grams
    and ``RELATIVE`` of the share it has in any other; so the filter holds at most 1 / ``LEAST_SHARE`` n-grams of a
    language, whatever the size of the corpus, and only those reach the driver.
    """
    learn = docs.filter(F.coalesce(remainder(F.col("doc_id"), FOLDS) != HELD_OUT, F.lit(True)))
    counts = stored(count_grams(learn.select("lang", "text")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    frequent = shares.filter(F.col("share") >= LEAST_SHARE)
    best = frequent.groupBy("gram").agg(F.max("share").alias("best"))
    chosen = frequent.join(best, "gram").filter(F.col("share") >= RELATIVE * F.col("best"))
    found = chosen.select("lang", "gram").toPandas()
    return build(found) if len(found) else None


def identify(docs: DataFrame, model: LanguageFilter | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every whole text.

    One row per row of the input, repeated rows and null ids included (a null id is not held out). A text that is null
    or has no letter is ``und`` with score 0, and so is every text if no document had a language. Language, source and
    id do not enter a prediction; other columns are ignored.
    """
    model = model or train(docs)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        rows = [model.predict(t) if model else ("und", 0.0) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predict("text").alias("p"))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "p.lang_pred", "p.score")
