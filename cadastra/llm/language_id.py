"""Language identification in two steps: the language family first, then one-versus-one linear SVMs within it.

Profiles are square-rooted, length-normalised counts of hashed byte pairs and triples of the whole lower-cased text.
A family of one learned language needs no second step.

Defined results: null text or no letter gives ``und`` with score 0; no labelled row at all gives ``und`` everywhere;
a null id is never held out and never learned from; equal texts get equal answers; extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ISO 639-1 codes by language family. A code that is not listed is a family of its own.
FAMILY = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es it pt ro ca gl oc la co sc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br gv kw",
    "uralic": "fi et hu se",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi ur bn pa gu mr ne si or as",
    "iranian": "fa ps ku tg",
    "semitic": "ar he am mt",
}
FAMILY_OF = {code: family for family, codes in FAMILY.items() for code in codes.split()}

WIDTH = 4096
CHUNK = 1 << 20
PER_LANGUAGE = 400
#: ``keep_identified`` rejects what scores less: a margin of zero in both steps gives this much, a half times a half.
LEAST = 0.25
RUN = re.compile(rb"  +")
#: ASCII bytes that are not letters become spaces; letters and the bytes of other characters stay.
BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.split("-")[0].split("_")[0].lower(), lang)


def has_letter(text: str | None) -> bool:
    """Whether some character is of the category letter; number signs such as Roman numerals aren't."""
    return bool(text) and any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """The unit vector of a whole text, gathered in chunks so that memory does not grow with it."""
    data = RUN.sub(b" ", text.lower().encode("utf-8", "replace").translate(BLANKED))
    counts, half = np.zeros(WIDTH), WIDTH // 2
    for at in range(0, len(data), CHUNK):
        # a chunk counts the pairs and triples that end in it
        back = min(2, at)
        x = np.frombuffer(data[at - back : at + CHUNK], np.uint8).astype(np.uint32)
        pair = x[:-1] * np.uint32(256) + x[1:]
        triple = pair[:-1] * np.uint32(256) + x[2:]
        pair = pair[max(0, back - 1) :]
        counts[:half] += np.bincount((pair * np.uint32(2654435761)) >> np.uint32(21), minlength=half)
        counts[half:] += np.bincount((triple * np.uint32(2246822519)) >> np.uint32(21), minlength=half)
    out = np.sqrt(counts)
    return (out / max(np.linalg.norm(out), 1e-9)).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30, seed: int = 7) -> np.ndarray:
    """Hinge-loss linear SVM by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    square, alpha, w = (x * x).sum(1), np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(x)):
            grad = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - grad / square[i], 0.0), c)
            if new != alpha[i]:
                worst = max(worst, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


class Pairwise:
    """One-versus-one linear SVMs with votes; ties go to the larger sum of margins, then to the first class by name."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.classes = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        at = np.array([self.classes.index(v) for v in labels])
        ws = []
        for a, b in self.pairs:
            keep = (at == a) | (at == b)
            ws.append(train_svm(x[keep], np.where(at[keep] == a, 1.0, -1.0)))
        self.w = np.array(ws, np.float32).T if ws else np.zeros((x.shape[1] + 1, 0), np.float32)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class numbers, and how sure: the logistic of twice the winner's smallest margin."""
        n, k = len(x), len(self.classes)
        margins = x @ self.w[:-1] + self.w[-1]
        votes, total, least = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        for j, (a, b) in enumerate(self.pairs):
            for c, m in ((a, margins[:, j]), (b, -margins[:, j])):
                votes[:, c] += m > 0
                total[:, c] += m
                least[:, c] = np.minimum(least[:, c], m)
        best = np.lexsort((np.broadcast_to(-np.arange(k), (n, k)), total, votes))[:, -1] if k > 1 else np.zeros(n, int)
        return best, 1 / (1 + np.exp(-2 * least[np.arange(n), best]))


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str]):
        families = [family_of(v) for v in langs]
        self.top = Pairwise(x, families) if langs else None
        self.inner = {}
        for f in sorted(set(families)):
            keep = np.array([v == f for v in families])
            self.inner[f] = Pairwise(x[keep], [v for v in langs if family_of(v) == f])

    def predict(self, texts: list[str | None], step: int = 256) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if self.top and has_letter(t)]
        for lo in range(0, len(known), step):
            rows = known[lo : lo + step]
            x = np.array([profile(texts[i]) for i in rows])
            family, sure = self.top.decide(x)
            for f in np.unique(family):
                own, svm = np.flatnonzero(family == f), self.inner[self.top.classes[f]]
                lang, surer = svm.decide(x[own])
                for i, k, s in zip(own, lang, surer, strict=True):
                    langs[rows[i]], scores[rows[i]] = svm.classes[k], float(sure[i] * s)
        return langs, scores


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from about ``per_language`` labelled rows of each language, chosen by a hash of the id; only their fixed-size profiles reach the driver."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = rows.where(F.col("l").isNotNull() & F.col("t").isNotNull() & F.col("i").isNotNull() & ~held_out("i"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel(np.zeros((0, WIDTH), np.float32), [])
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))])
    chosen = rows.where(F.pmod(F.xxhash64("i", F.lit(11)), F.lit(1_000_003)) < F.element_at(share, F.col("l")) * 1_000_003)

    def profiles(batches):
        for b in batches:
            got = [(lang, profile(t)) for lang, t in zip(b.column("l").to_pylist(), b.column("t").to_pylist(), strict=True) if has_letter(t)]
            yield pa.RecordBatch.from_pydict({"l": pa.array([g[0] for g in got], pa.string()), "p": pa.array([g[1].astype(np.float16).tobytes() for g in got], pa.binary())})

    got = chosen.select("l", "t").mapInArrow(profiles, "l string, p binary").collect()
    got.sort(key=lambda r: (r["l"], bytes(r["p"])))
    return LanguageModel(np.array([np.frombuffer(r["p"], np.float16) for r in got], np.float32).reshape(len(got), WIDTH), [r["l"] for r in got])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""

    def predict(batches):
        for b in batches:
            langs, scores = model.predict(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("h"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), held_out(id_col).alias("h"), F.col(text_col).alias("t"))
    return rows.mapInArrow(predict, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents, all columns, whose language is known with a score of at least ``least``; a missing language is filled in."""

    def keep(batches):
        for b in batches:
            langs, scores = model.predict(b.column(text_col).to_pylist())
            if lang_col in b.schema.names:
                at = b.schema.get_field_index(lang_col)
                filled = pc.coalesce(b.column(at), pa.array(langs, b.schema.field(at).type))
                b = b.set_column(at, b.schema.field(at), filled)
            yield b.filter(pa.array([lang != "und" and s >= least for lang, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
