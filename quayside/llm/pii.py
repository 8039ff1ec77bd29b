"""Personal data: fixed rules, and candidate spans that boosted trees accept or refuse.

The base rules find e-mail addresses, IP addresses, card numbers and phone numbers. High-recall generators propose
further, overlapping spans (addresses in disguise, numbers in other formats, credentials). Boosted trees score each by
features of its format and of its context; a threshold on calibrated probabilities selects. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.boosting import BoostedTrees

KINDS = ("email", "ip", "card", "phone", "secret")
Span = tuple[str, int, int]

# -- base rules -----------------------------------------------------------------------------------------------------

# The characters and shapes of the base rules. A look-behind replaces the search for a start inside a
# run, which finds the same matches in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        after = domain.end() if domain else at + 1
        if domain:
            found.append(("email", start, after))
        at = text.find("@", after)
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of the four base rules, ordered by kind, then start."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m.group())]
        found += [("card", *m.span()) for m in _CARD.finditer(text)
                  if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


# -- candidates -----------------------------------------------------------------------------------------------------

_GENERATORS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]++\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[\w-]++"
                        r"(?:\s?(?:\.|\(dot\)|\[dot\]|\bdot\b)\s?[\w-]++)+", re.I),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}+(?:[.][0-9]{1,3}+){3}+(?![\w.]*[0-9])"),
    "phone": re.compile(r"(?<![\w+(])(?:\+|00)?[ ]?\(?[0-9]{2,4}+\)?(?:[ ./-]?\(?[0-9]{2,4}+\)?){2,4}+(?!\w)"),
    "card": re.compile(r"(?<![\w-])[0-9]{4}(?:[ ._-]?[0-9]{3,6}+){2,4}+(?![\w-])"),
    "secret": re.compile(r"\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?\S{6,}+"
                         r"|(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{18,}+(?![A-Za-z0-9_-])"),
}
# Words that announce personal data in the corpus languages.
_CUES = ("mail", "phone", "tel", "call", "fax", "mobile", "card", "visa", "credit", "account", "ip", "host", "server",
         "password", "secret", "token", "key", "telefon", "karte", "carte", "tarjeta", "correo", "llame")
_CUE = re.compile(r"(?:" + "|".join(_CUES) + r")\W*$", re.I)
_CONTEXT = 24
_AT = re.compile(r"@|\bat\b", re.I)
_KEY = re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?")
_SECRET = re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]|AKIA[0-9A-Z]{16}$|[0-9a-f]{32,64}$")


def candidates(text: str) -> list[Span]:
    found = []
    digit = _DIGIT.search(text)
    if digit:
        for kind in ("ip", "phone", "card"):
            found += [(kind, *m.span()) for m in _GENERATORS[kind].finditer(text)]
    if digit or ":" in text or "=" in text:  # a value after a key word needs no digit
        found += [("secret", *m.span()) for m in _GENERATORS["secret"].finditer(text)]
    if _AT.search(text):
        found += [("email", *m.span()) for m in _GENERATORS["email"].finditer(text)]
    return found


def features(kind: str, text: str, before: str, after: str) -> list[float]:
    """Numbers on the format of a candidate and on the characters around it."""
    n = len(text)
    digits = _digits(text)
    counts = Counter(text).values()
    groups = re.split(r"\D+", text.strip("+() "))
    plain = re.sub(r"\s?[(\[]\s?(?:at)\s?[)\]]\s?|\s+at\s+", "@", text, flags=re.I)
    plain = re.sub(r"\s?[(\[]\s?(?:dot)\s?[)\]]\s?|\s+dot\s+", ".", plain, flags=re.I)
    domain = plain.rpartition("@")[2]
    last = domain.rpartition(".")[2]
    parts = text.split(".")
    return [
        KINDS.index(kind), n, len(digits), len(digits) / n, sum(c.isupper() for c in text) / n,
        sum(c.isalpha() for c in text) / n, -sum(k / n * math.log2(k / n) for k in counts),
        len(set(digits)), float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)),
        len(groups), max(map(len, groups)), min(map(len, groups)), float(text.startswith(("+", "00"))),
        float("(" in text), text.count("-"), text.count("."), text.count(" "), float(text.count("@") == 1),
        float(plain.count("@") == 1), float("." in domain), len(last), float(last.isalpha()),
        float(bool(re.search(r"\bat\b", text, re.I)) and "(" not in text and "[" not in text),
        float(bool(_SECRET.search(text))), float(bool(_CUE.search(before))), float(before[-1:].isspace() or not before),
        float(after[:1].isspace() or after[:1] in ".,;:!?\"'" or not after), float(before[-1:] in "$€£#"),
        float(digits[:2] in ("19", "20")), float([len(g) for g in groups[-3:]] == [3, 3, 4]),
    ]


WIDTH = len(features("ip", "1.2.3.4", "", ""))


def _around(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - _CONTEXT):start], text[end:end + _CONTEXT]


# -- training -------------------------------------------------------------------------------------------------------

# The model is fitted on this many candidates of the whole corpus, those with the smallest hash.
SAMPLE = 6_000
# The accepted share of wrong spans among the selected ones of the calibration fold, and the least threshold.
WRONG, LEAST = 0.01, 0.6


def _weak_label(kind: str, text: str, truth: set[Span], span: Span) -> int | None:
    """1 for a span that a base rule or a credential format proves, 0 for one that they refute, None if unknown."""
    if any(t[1] <= span[1] and span[2] <= t[2] for t in truth):
        return 1 if (kind, *span[1:]) in truth else None
    if kind == "secret":
        return 1 if _SECRET.search(text) else None
    if kind == "email":
        return None if "@" in text or "(" in text or "[" in text else 0
    if kind == "phone" and (re.search(r"\)", text) or text.startswith(("+", "00"))):
        return None
    return 0


def _variants(kind: str, text: str, rng: random.Random) -> list[tuple[str, int]]:
    """The same datum in other formats (1), and look-alikes that are none (0)."""
    digits = _digits(text)
    noise = "".join(rng.choice("0123456789") for _ in range(rng.randint(6, 12)))
    day = f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"
    out = [(noise, 0), (day, 0), (f"{noise[:3]}.{noise[3:6]}", 0)]
    if kind == "email":
        name, _, host = text.partition("@")
        out += [(f"{name} (at) {host.replace('.', ' (dot) ')}", 1), (f"{name}[at]{host.replace('.', '[dot]')}", 1),
                (f"{name} at {host.split('.')[0]}. {name}", 0)]
    elif kind == "ip":
        parts = text.split(".")
        out += [(".".join([*parts[:3], str(rng.randint(256, 999))]), 0), (".".join(parts[:3]), 0)]
    elif kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        for sep, label, d in (("", 0, wrong), (" ", 0, wrong), (" ", 1, digits), ("-", 1, digits), (".", 1, digits)):
            out.append((sep.join(d[k:k + 4] for k in range(0, len(d), 4)), label))
    elif kind == "phone" and len(digits) >= 10:
        d = digits[-10:]
        out += [(f"({d[:3]}) {d[3:6]}-{d[6:]}", 1), (f"{d[:3]}-{d[3:6]}-{d[6:]}", 1), (f"00{digits}", 1), (d, 0),
                (f"{d[:2]} {d[2:4]} {d[4:6]}", 0)]
    elif kind == "secret":
        out += [("".join(c for c in text if c.isalpha())[:30] or "word", 0), ("0" * len(text), 0)]
        if key := _KEY.match(text):  # a value may be letters only, or long as signed tokens are
            letters = "abcdefghijklmnopqrstuvwxyz"
            out.append((key.group() + "".join(rng.choices(letters, k=rng.randint(8, 30))), 1))
            signed = letters + letters.upper() + "0123456789-_."
            out.append((key.group() + "".join(rng.choices(signed, k=rng.randint(100, 1500))), 1))
    return out


def _examples(docs: DataFrame, seed: int) -> DataFrame:
    """Labelled candidates of all documents, with their variants, as feature vectors."""
    def run(batches):
        for batch in batches:
            xs, ys, hs = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                truth = set(base_spans(text))
                for span in dict.fromkeys([*candidates(text), *truth]):
                    shown, before, after = _around(text, *span[1:])
                    label = _weak_label(span[0], shown, truth, span)
                    if label is None:
                        continue
                    name = hashlib.blake2b(f"{seed}|{shown}|{before}".encode(), digest_size=8).digest()
                    rng = random.Random(name)
                    for other, y in [(shown, label), *(_variants(span[0], shown, rng) if label else [])]:
                        xs.append(features(span[0], other, before, after))
                        ys.append(y)
                        hs.append(int.from_bytes(name, "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hs, pa.int64()), pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.int32())],
                names=["h", "x", "y"])
    return docs.select("text").mapInArrow(run, "h long, x array<double>, y int")


@dataclass
class PiiModel:
    trees: BoostedTrees | None
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.offset, -40, 40)))


def train(docs: DataFrame, sample: int = SAMPLE, seed: int = 7) -> PiiModel:
    """Fit the trees on ``sample`` weakly labelled candidates of all documents; without both labels, accept nothing.

    A fifth of the sample calibrates the margins (a logistic fit) and sets the least threshold at which at most
    ``WRONG`` of the selected spans are refuted ones.
    """
    # Only hashes, feature vectors and labels of the bounded sample reach the driver.
    # Copies of a document repeat its examples, so these are made distinct before they are counted.
    rows = _examples(docs, seed).distinct().orderBy("h", "y", "x").limit(sample * 8).collect()
    if len({r.y for r in rows}) < 2:
        return PiiModel(None)
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows], float)
    held = np.array([r.h % 5 == 0 for r in rows])
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held = np.arange(len(y)) % 5 == 0
    trees = BoostedTrees().fit(x[~held], y[~held])
    margin, truth = trees.margin(x[held]), y[held]
    slope, offset = 1.0, 0.0
    for _ in range(200):  # gradient steps of the logistic calibration
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -40, 40)))
        slope -= 0.05 * float(np.mean((p - truth) * margin)) / (1 + float(np.mean(margin**2))) * 4
        offset -= 0.05 * float(np.mean(p - truth)) * 4
    model = PiiModel(trees, slope, offset)
    p = model.probabilities(x[held])
    order = np.argsort(-p, kind="stable")
    wrong = np.cumsum(1 - truth[order]) / np.arange(1, len(order) + 1)
    passing = np.flatnonzero(wrong <= WRONG)
    model.threshold = max(LEAST, float(p[order][passing[-1]]) if len(passing) else 1.0)
    return model


def detect(text: str, model: PiiModel) -> list[Span]:
    """All spans of a text by kind and start: the base spans and the accepted candidates that overlap no other."""
    found = base_spans(text)
    if model.trees is None:
        return found
    taken = [(s, e) for _, s, e in found]
    proposed = [c for c in candidates(text) if not any(c[1] < e and s < c[2] for s, e in taken)]
    if proposed:
        x = np.array([features(c[0], *_around(text, *c[1:])) for c in proposed])
        scores = model.probabilities(x)
        last: list[Span] = []
        for k in sorted(range(len(proposed)), key=lambda k: (-scores[k], proposed[k][1], -proposed[k][2])):
            c = proposed[k]
            if scores[k] >= model.threshold and not any(c[1] < o[2] and o[1] < c[2] for o in last):
                last.append(c)
        found = found + last
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with a mark such as ``<EMAIL>`` in place of each span; overlapping spans share the first one's mark."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


# -- operators ------------------------------------------------------------------------------------------------------

_REPORT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
           "n_added long")


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """Per document the counts of base spans, their digest, and all spans (``kind:start:end``, code points).

    One row per row of the input, repeated rows and null ids included; a null text counts as empty, other columns are
    ignored. Whole texts are searched; a text is one row of one task, whatever its length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = model or train(rows)

    def run(batches):
        for batch in batches:
            out = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base, spans = base_spans(text), detect(text, model)
                kinds = [s[0] for s in base]
                out.append((*(kinds.count(k) for k in KINDS[:4]), hashlib.sha256(_joined(base).encode()).hexdigest(),
                            _joined(spans), len(spans) - len(base)))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.string() if 4 <= k <= 5 else pa.int64())
                                           for k, c in enumerate(columns))],
                names=[c.split()[0] for c in _REPORT.split(", ")])
    return rows.mapInArrow(run, _REPORT)


def redact_pii(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """The documents, all columns kept, with every span of personal data in ``text`` replaced by a mark. A null text
    stays null; ``n_chars``, where present, follows the text."""
    model = model or train(docs)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, detect(t, model)), na_action="ignore")

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
