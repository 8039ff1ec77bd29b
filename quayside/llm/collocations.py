"""Collocations by prefix-free parsing.

A text is parsed at places that its own words choose: where a window of four tokens hashes to a given residue, one chunk
ends after the window and the next begins with it. Equal passages parse alike wherever they occur, so the parse is a
dictionary of distinct chunks with frequencies. Phrases of up to five words are counted inside the distinct chunks,
weighted by these frequencies. Neighbouring chunks share the window; a phrase belongs to the chunk in which it begins
before the closing window, so every occurrence counts once. Breaks between pieces of text are tokens of the parse, and
no phrase contains one.

Phrases are counted by length. A phrase can only be frequent if both phrases without its last and its first word are,
so before a length is counted, places are dropped whose shorter phrases have no bit in a bitmap of the frequent ones.
The bitmap has a fixed size; a chance bit costs work, never a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import stored

LONGEST, LEAST, TOP = 5, 100, 2_000
WINDOW = LONGEST - 1            # tokens that neighbouring chunks share
RESIDUES = 32                   # one window in so many ends a chunk
NEAREST, FARTHEST = 16, 512     # tokens that a chunk begins at least and at most before it ends
BITS = 1 << 26                  # of the bitmap, 8 MB; a power of two
AT_ONCE = 4_000_000             # characters counted together
HELD = 20_000                   # chunks that a task holds before it passes them on
BREAK = "\n"                    # the token between pieces; no word, as line breaks end pieces

# On UTF-8 bytes: A to Z are lowered, what ends a piece becomes a break, a tab a blank.
_BYTES = bytes(10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
_BREAKS = re.compile(r"\n[\n ]+")
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_COUNTED = "lang string, phrase string, f long"
_DICTIONARY = "lang string, chunk string, own int, n_words int, frequency long"


class _Codes(dict):
    """A checksum per token, remembered while a task runs."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        code = self[token] = crc32(token.encode("utf-8", "surrogatepass"))
        return code


def tokens(text: str | None) -> list[str]:
    """The words of a text, with A to Z in lower case, and one break between pieces that have words."""
    mapped = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).decode("utf-8", "surrogatepass")
    found = list(filter(None, _BREAKS.sub(BREAK, mapped).replace(BREAK, f" {BREAK} ").split(" ")))
    return found[found[:1] == [BREAK]:len(found) - (found[-1:] == [BREAK])]


def parse(sequence: list[str], codes: dict[str, int]) -> Iterator[tuple[int, int, int]]:
    """The chunks of a text as (begin, end, own): the tokens, and how many of them begin phrases here.

    All tokens of the last chunk do; in the others all but those of the closing window, with which the next begins.
    """
    n = len(sequence)
    begin = 0
    if n > NEAREST + WINDOW:
        code = np.fromiter(map(codes.__getitem__, sequence), np.uint32, n)
        m = n - WINDOW  # windows that leave a token after them
        mixed = code[:m] ^ code[1:m + 1] * np.uint32(3) ^ code[2:m + 2] * np.uint32(5) ^ code[3:m + 3] * np.uint32(7)
        for at in np.flatnonzero(mixed * np.uint32(0x9E3779B1) >> np.uint32(8) & np.uint32(RESIDUES - 1) == 0).tolist():
            while at - begin > FARTHEST:
                yield begin, begin + FARTHEST + WINDOW, FARTHEST
                begin += FARTHEST
            if at - begin >= NEAREST:
                yield begin, at + WINDOW, at - begin
                begin = at
    while n - begin > FARTHEST + WINDOW:
        yield begin, begin + FARTHEST + WINDOW, FARTHEST
        begin += FARTHEST
    if n:
        yield begin, n, n - begin


def parse_documents(docs: DataFrame) -> DataFrame:
    """The dictionary, one row per distinct chunk: ``lang`` (null: ``und``), ``chunk`` (tokens joined by blanks),
    ``own`` (tokens that begin phrases here), ``n_words`` among them, and ``frequency``."""
    def run(batches):
        counts: dict[tuple[str, str, int, int], int] = {}
        codes = _Codes()

        def flush():
            langs, chunks, own, n_words = zip(*counts)
            found = pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(chunks, pa.string()), pa.array(own, pa.int32()),
                 pa.array(n_words, pa.int32()), pa.array(counts.values(), pa.int64())],
                names=["lang", "chunk", "own", "n_words", "frequency"])
            counts.clear()
            return found

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                sequence = tokens(text.as_py())
                for begin, end, own in parse(sequence, codes):
                    chunk = " ".join(sequence[begin:end])
                    breaks = chunk.count(BREAK) - sequence[begin + own:end].count(BREAK) if BREAK in chunk else 0
                    key = (lang, chunk, own, own - breaks)
                    counts[key] = counts.get(key, 0) + 1
                if len(counts) >= HELD:
                    yield flush()
        if counts:
            yield flush()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    parsed = rows.mapInArrow(run, _DICTIONARY)
    return parsed.groupBy("lang", "chunk", "own", "n_words").agg(F.sum("frequency").alias("frequency"))


def _word_codes(lang: str, found: Iterable[str]) -> np.ndarray:
    """A 64-bit number per word and language, from a checksum that goes on from that of the language. Its 32 bits exceed
    those of a place in the bitmap."""
    begin = crc32(lang.encode("utf-8", "surrogatepass") + b"\x00")
    codes = np.array([crc32(w.encode("utf-8", "surrogatepass"), begin) for w in found], np.uint64)
    return (codes ^ (codes >> np.uint64(29))) * _MIX


def _bit(rolled: np.ndarray) -> np.ndarray:
    """Which bit of the bitmap stands for a phrase, from its rolled code."""
    return ((rolled ^ (rolled >> np.uint64(32))) * _MIX >> np.uint64(64 - (BITS - 1).bit_length())).astype(np.int64)


def _roll(codes: np.ndarray, n: int) -> np.ndarray:
    """The code of the ``n`` words that begin at each place; the last ``n - 1`` places have none."""
    rolled = codes[:max(0, len(codes) - n + 1)]
    for k in range(1, n):
        rolled = rolled * _STEP + codes[k:len(codes) - n + 1 + k]
    return rolled


class _Laid:
    """Chunks of one language, token by token."""

    def __init__(self, lang: str, chunks: list[str], own: np.ndarray, frequency: np.ndarray):
        text = " ".join(chunks).split(" ")
        known: dict[str, int] = dict(zip(dict.fromkeys(text), count()))
        self.lang, self.names, self.own, self.frequency = lang, list(known), own, frequency
        self.ids = np.fromiter(map(known.__getitem__, text), np.int64, len(text))
        self.sizes = np.fromiter((c.count(" ") + 1 for c in chunks), np.int64, len(chunks))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.breaks = np.concatenate([[0], np.cumsum(self.ids == known.get(BREAK, -1))])

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a phrase of ``n`` words begins, and the chunk it is in."""
        wide = np.clip(np.minimum(self.own, self.sizes - n + 1), 0, None)
        chunk = np.repeat(np.arange(len(wide)), wide)
        at = np.arange(len(chunk)) + np.repeat(self.starts - np.cumsum(wide) + wide, wide)
        whole = self.breaks[at + n] == self.breaks[at]
        return at[whole], chunk[whole]

    def frequent(self, n: int, bitmap: np.ndarray) -> np.ndarray:
        """Per place whether the bitmap has the ``n`` words that begin there; no phrase with a break is in it but by
        chance."""
        bit = _bit(_roll(_word_codes(self.lang, self.names)[self.ids], n))
        return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

    def counted(self, n: int, at: np.ndarray, chunk: np.ndarray) -> pa.RecordBatch:
        """The phrases at these places with the sum of their chunks' frequencies. Phrases are told apart by the numbers
        of their words, not by hashes."""
        weights = self.frequency[chunk]
        if n == 1:
            totals = np.zeros(len(self.names), np.int64)
            np.add.at(totals, self.ids[at], weights)
            first = np.flatnonzero(totals)
            columns, totals = [first], totals[first]
        else:
            key, size = np.zeros(len(at), np.int64), 1
            for k in range(n):
                if size * len(self.names) >= 1 << 62:
                    distinct, key = np.unique(key, return_inverse=True)
                    size = len(distinct)
                key, size = key * len(self.names) + self.ids[at + k], size * len(self.names)
            order = np.argsort(key)
            begins = np.flatnonzero(np.diff(key[order], prepend=-1))
            totals = np.add.reduceat(weights[order], begins) if len(begins) else weights
            columns = [self.ids[at[order[begins]] + k] for k in range(n)]
        names = pa.array(self.names, pa.string())
        phrases = pc.binary_join_element_wise(*[names.take(pa.array(c)) for c in columns], " ")
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.lang, pa.string()), len(totals)), phrases, pa.array(totals)],
            names=["lang", "phrase", "f"])

    def runs(self, n: int, bitmap: np.ndarray) -> pa.RecordBatch:
        """What is left of the chunks for phrases of more than ``n`` words: stretches in which every phrase of ``n``
        words is frequent."""
        good = np.zeros(len(self.ids) + 1, bool)
        here = self.frequent(n, bitmap)
        good[:len(here)] = here & (self.breaks[n:] == self.breaks[:len(here)])
        # A phrase may reach into the closing window, but not beyond its chunk.
        ends = self.starts + self.sizes
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        good[:-1] &= np.arange(len(self.ids)) + n <= ends[owner]
        begin = np.flatnonzero(good & ~np.concatenate([[False], good[:-1]]))
        # Where the last frequent phrase of a chunk meets the first of the next, the stretch is cut.
        cut = np.flatnonzero(good[:-1] & np.concatenate([[False], good[:-2]]) & np.isin(
            np.arange(len(self.ids)), self.starts))
        begin = np.sort(np.concatenate([begin, cut]))
        bad = np.flatnonzero(~good)
        end = bad[np.searchsorted(bad, begin)]
        end = np.minimum(end, ends[owner[begin]])
        inside = owner[begin]
        own = np.minimum(self.own[inside] + self.starts[inside], end) - begin
        keep = (end - begin > 1) & (own > 0)
        begin, end, own, inside = begin[keep], end[keep] + n - 1, own[keep], inside[keep]
        size = end - begin
        at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        words = pa.array(self.names, pa.string()).take(pa.array(self.ids[at]))
        texts = pc.binary_join(pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), words), " ")
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.lang, pa.string()), len(texts)), texts,
             pa.array(own.astype(np.int32)), pa.array(own.astype(np.int32)), pa.array(self.frequency[inside])],
            names=["lang", "chunk", "own", "n_words", "frequency"])


def _laid_out(batches: Iterable[pa.RecordBatch]) -> Iterator[_Laid]:
    """The chunks of a task, some million characters of one language at a time."""
    held: dict[str, list[pa.RecordBatch]] = {}
    waiting: dict[str, int] = {}

    def give(lang: str) -> _Laid:
        table = pa.Table.from_batches(held.pop(lang))
        waiting.pop(lang)
        return _Laid(lang, table["chunk"].to_pylist(), table["own"].to_numpy().astype(np.int64),
                     table["frequency"].to_numpy())

    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            part = batch.filter(pc.equal(langs, lang))
            held.setdefault(lang, []).append(part)
            waiting[lang] = waiting.get(lang, 0) + (pc.sum(pc.binary_length(part.column("chunk"))).as_py() or 0)
            if waiting[lang] >= AT_ONCE:
                yield give(lang)
    for lang in list(held):
        yield give(lang)


def _counts(n: int, bitmap: np.ndarray | None, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of ``n`` words in batches of chunks, with their weighted counts."""
    for laid in _laid_out(batches):
        at, chunk = laid.places(n)
        if bitmap is not None and len(at):
            frequent = laid.frequent(n - 1, bitmap)
            keep = frequent[at] & frequent[at + 1]
            at, chunk = at[keep], chunk[keep]
        if len(at):
            yield laid.counted(n, at, chunk)


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """Bits of the frequent phrases. The driver receives distinct bytes of the bitmap, at most ``BITS / 8`` rows."""
    def run(batches):
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            bits = np.zeros(len(phrases), np.int64)
            for lang in dict.fromkeys(langs):
                rows = [i for i, other in enumerate(langs) if other == lang]
                known: dict[str, int] = {}
                ids = [[known.setdefault(w, len(known)) for w in phrases[i].split(" ")] for i in rows]
                codes = _word_codes(lang, known)
                n = len(ids[0])
                rolled = codes[[i[0] for i in ids]]
                for k in range(1, n):
                    rolled = rolled * _STEP + codes[[i[k] for i in ids]]
                bits[rows] = _bit(rolled)
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 3), pa.array(1 << (bits & 7))], names=["place", "bits"])

    placed = frequent.select("lang", "phrase").mapInArrow(run, "place long, bits long")
    found = placed.groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    bitmap = np.zeros(BITS // 8, np.uint8)
    bitmap[found["place"].to_numpy(np.int64)] = found["bits"].to_numpy(np.uint8)
    return bitmap


def frequent_phrases(dictionary: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that occur ``least`` times in a language, with ``size`` (words) and ``f``;
    and per language ``n``, the number of all word occurrences. ``dictionary`` is stored, as several lengths read it."""
    context = dictionary.sparkSession.sparkContext
    totals = stored(dictionary.groupBy("lang").agg(F.sum(F.col("n_words") * F.col("frequency")).alias("n")))
    found: list[DataFrame] = []
    shared = None
    for n in range(1, longest + 1):
        if n > 2:
            # What is left is little, so the longer lengths do not read the whole dictionary again.
            def narrow(batches, n=n, shared=shared):
                for laid in _laid_out(batches):
                    yield laid.runs(n - 1, shared.value)
            dictionary = stored(dictionary.mapInArrow(narrow, _DICTIONARY))

        def tally(batches, n=n, shared=shared if n == 2 else None):
            return _counts(n, None if shared is None else shared.value, batches)

        counted = dictionary.mapInArrow(tally, _COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        level = stored(counted.filter(F.col("f") >= least).withColumn("size", F.lit(n)))
        found.append(level)
        if n < longest:
            shared = context.broadcast(_bitmap(level))
    phrases = found[0]
    for level in found[1:]:
        phrases = phrases.unionByName(level)
    return phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Per language (null: ``und``) the first ``top`` collocations: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n`` and ``score``.

    Words are the runs without space and tab inside pieces, which end at ``. , ; : ! ?`` and line breaks; A to Z are
    lowered. A phrase of two to five words that occurs ``a >= least`` times is a candidate. A cut after its first words
    gives the counts ``l`` and ``r`` of both parts and floor(1000 * a * n / (l * r)), exact in 38 digits; the cut with
    the lowest score counts, of equal ones the first. A candidate inside a longer one as frequent is dropped. Ties are
    ranked by ``a``, then by the bytes of the phrase.

    Null and empty texts have no words. Repeated rows count as often as they occur, ids and other columns are ignored.
    An empty table, or one without frequent phrases, gives an empty result.
    """
    return rank_collocations(*frequent_phrases(stored(parse_documents(docs)), least), top)


def rank_collocations(phrases: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The collocations among the results of ``frequent_phrases``."""
    candidates = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))

    # A phrase is at most as frequent as a part of it, so a longer phrase as frequent leads through ones of a word more.
    inner = candidates.filter("size > 2").select(
        "lang", F.col("f").alias("a"), F.explode(F.array(
            F.array_join(F.slice("words", 1, F.col("size") - 1), " "),
            F.array_join(F.slice("words", 2, F.col("size") - 1), " "))).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 100 * f")

    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice("words", 1, k), " ").alias("first"),
            F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("rest")))).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.k", "cut.first", "cut.rest")
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    counted = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    # Products of counts pass 64 bits; div on decimals floors the exact quotient.
    score = F.expr("(1000BD * cast(a AS decimal(16,0)) * cast(n AS decimal(17,0))) div "
                   "(cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    best = counted.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "best.*").withColumn("rank", F.row_number().over(order))
    # The filter on the plain number lets every task pass on its first rows only.
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
