"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams (one to
``MAX_GRAM`` letters, words padded by one space) that are present in both, over
the geometric mean of how many each has: a blended-spectrum presence kernel.
N-grams are told apart by a hash of ``BITS`` bits.

1. About ``PER_CLASS`` labelled texts of each language, chosen by the hash of
   their id, form the training sample; the first ``LANDMARKS`` of them are landmarks,
   dealt evenly among the languages.
2. A text's features are its kernels with the landmarks times the inverse square
   root of the landmarks' own kernel matrix (Nystroem).
3. One-versus-rest kernel ridge regression gives a weight vector per language.
4. Texts are scored in batches: presence matrix times landmark matrix times
   weights.  The language of the greatest value wins, ties going to the first
   in order; the score is its softmax share.

Scoring is one pass without a shuffle; only the text is an input.  A text that
is null or has no letter is ``und`` with score 0, and so is every text if no
labelled row exists.  Repeated rows get equal results; an empty table gives no
rows; other columns are not read.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_fold, documents, hash_sample, keyed_texts

MAX_GRAM, BITS = 3, 14
PER_CLASS, LANDMARKS, RIDGE, SHARPNESS = 800, 160, 1e-3, 8.0
BATCH = 256
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> np.ndarray:
    """Lower-cased code points; what is not a letter becomes one space."""
    clean = OTHER.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, clean)):
        return np.zeros(0, np.uint32)
    return np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix of n-gram presence (a row for each text), and which texts have letters."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    has = np.zeros(len(texts), bool)
    for k, t in enumerate(texts):
        chars = letters(t)
        if len(chars) == 0:
            continue
        has[k] = True
        gram = np.zeros(len(chars), np.uint32)
        for n in range(1, MAX_GRAM + 1):
            gram = (gram[: len(chars) - n + 1] + chars[n - 1:]) * np.uint32(0x9E3779B1) + np.uint32(n)
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA77)
            out[k, mixed >> np.uint32(32 - BITS)] = 1.0
    return out, has


@dataclass
class LanguageModel:
    names: list[str]
    landmarks: np.ndarray  # presence rows over their norms
    weights: np.ndarray  # from kernels with the landmarks to one value per language

    def values(self, rows: np.ndarray) -> np.ndarray:
        return kernels(rows, self.landmarks) @ self.weights


def kernels(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
    return (rows @ landmarks.T) / norm


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Nystroem features and ridge weights from a bounded list of labelled texts."""
    names = sorted(set(langs))
    if not names:
        return None
    order: list[int] = []
    by = {n: [k for k, x in enumerate(langs) if x == n] for n in names}
    for depth in range(max(map(len, by.values()))):
        order += [v[depth] for v in by.values() if depth < len(v)]
    chosen, _ = presence([texts[k] for k in order[:landmarks]])
    chosen /= np.sqrt(np.maximum(chosen.sum(1, keepdims=True), 1))
    own = (chosen @ chosen.T).astype(float)
    value, vector = np.linalg.eigh(own)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    gram, target = np.zeros((root.shape[1],) * 2), np.zeros((root.shape[1], len(names)))
    for lo in range(0, len(texts), BATCH):
        rows, _ = presence(texts[lo:lo + BATCH])
        feats = kernels(rows, chosen) @ root
        y = np.array([[x == n for n in names] for x in langs[lo:lo + BATCH]], float) * 2 - 1
        gram += feats.T @ feats
        target += feats.T @ y
    solved = np.linalg.solve(gram + ridge * len(texts) * np.eye(len(gram)), target)
    return LanguageModel(names, chosen, (root @ solved).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for each row."""
    own = keyed_texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # LANDMARKS rows of 2 ** BITS numbers

    def run(batches):
        m = sent.value
        for batch in batches:
            for lo in range(0, len(batch), BATCH):
                part = batch.slice(lo, BATCH)
                rows, has = presence(part.column(1).to_pylist())
                if m is None:
                    lang, score = ["und"] * len(part), np.zeros(len(part))
                else:
                    v = m.values(rows)
                    best = v.argmax(1)
                    e = np.exp(SHARPNESS * (v - v.max(1, keepdims=True)))
                    score = np.where(has, 1 / e.sum(1), 0.0)
                    lang = [m.names[b] if h else "und" for b, h in zip(best, has)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score.astype(float))], ["id", "lang_pred", "score"])

    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def trained(docs: DataFrame, folds: int = 4, held_out: int = 2, per_class: int = PER_CLASS) -> LanguageModel | None:
    """A model from about ``per_class`` rows of each language outside the held-out fold."""
    rows = docs.select(F.col("doc_id").alias("id"), "lang", F.col("text").cast("string").alias("text"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold("id", folds) != held_out))
    sample = hash_sample(usable, "id", "lang", per_class).select("id", "lang", "text").toPandas()  # bounded by per_class
    sample = sample.sort_values(["id", "lang", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def q_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, trained(docs)).select(F.col("id").alias("doc_id"), (crc_fold("id", 4) == 2).alias("held_out"), "lang_pred", "score")
