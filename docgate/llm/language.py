"""Language by string kernels: n-gram presence, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_GRAMS = (1, 2, 3)
SLOTS = 1 << 16
SAMPLE = 2_400
LANDMARKS = 192
RIDGE = 1e-2
UNDETERMINED = "und"
# An n-gram is familiar if this share of the sampled rows of some language has it.
FAMILIAR_ROWS = 0.01
# Least share of a text's n-grams that are familiar; of the holdout of sf0.1, the smallest is 0.69.
MIN_FAMILIAR = 0.6
_AT_ONCE = 1 << 20
_ROWS = 64


def _slots(text: str):
    """Slots of the blended spectrum: hashed n-grams present in the lower-cased text."""
    import numpy as np

    present = np.zeros(SLOTS, dtype=bool)
    longest = max(N_GRAMS)
    # A long text goes piece by piece; pieces overlap, so no n-gram is missed.
    for at in range(0, max(len(text), 1), _AT_ONCE):
        piece = text[at : at + _AT_ONCE + longest - 1].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        mixed = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, longest + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            mixed = mixed[:m] * np.uint64(0x100000001B3) + codes[n - 1 :].astype(np.uint64) + np.uint64(n)
            if n in N_GRAMS:
                spread = mixed * np.uint64(0x9E3779B97F4A7C15)
                present[(spread >> np.uint64(48)).astype(np.int64)] = True
    return present


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    """One column of ``weights`` per language; a score is a presence row times the weights."""

    languages: list[str]
    weights: object  # float32 array, SLOTS x languages
    bias: object  # one number per language
    familiar: object = None  # a bool per slot; None: all are

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score (0 to 1) of each text."""
        return [(language, score) for language, score, _ in self.tell(texts)]

    def tell(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and share of familiar n-grams (both 0 to 1) of each text."""
        import numpy as np

        out: list[tuple[str, float, float]] = []
        for at in range(0, len(texts), _ROWS):
            some = texts[at : at + _ROWS]
            known = [_has_letter(text) and bool(self.languages) for text in some]
            rows = np.zeros((len(some), SLOTS), dtype=np.float32)
            for i, text in enumerate(some):
                if known[i]:
                    rows[i] = _slots(text)
            sizes = np.maximum(rows.sum(axis=1, keepdims=True), 1)
            scores = (rows / np.sqrt(sizes)) @ self.weights + self.bias
            seen = sizes if self.familiar is None else rows @ self.familiar.astype(np.float32)[:, None]
            shares = (seen / sizes)[:, 0]
            for i in range(len(some)):
                if known[i]:
                    best = int(scores[i].argmax())
                    score = float(np.clip((scores[i, best] + 1) / 2, 0, 1))
                    out.append((self.languages[best], score, float(shares[i])))
                else:
                    out.append((UNDETERMINED, 0.0, 0.0))
        return out


def fit(
    labelled: DataFrame,
    sample: int = SAMPLE,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> LanguageModel:
    """A model from at most ``sample`` rows of ``labelled`` (doc_id, text, lang), chosen by hash.

    Each sampled text, whole, becomes one row of presence bits in its task; the driver gets ``sample``
    rows of ``SLOTS`` bits. The kernel of two texts is the number of n-grams both have over the root of the
    product of the numbers each has. ``landmarks`` rows span the Nyström features; languages are
    fitted one against the rest by ridge regression on them, and folded into one weight per n-gram
    and language. Rows without language or letters are not used; repeated rows count as often as they
    are drawn; without rows the model knows no language.
    """
    import numpy as np

    def bits(frames: Iterable) -> Iterator:
        for frame in frames:
            texts = [None if t is None else str(t) for t in frame["text"]]
            keep = [_has_letter(t) for t in texts]
            yield pd.DataFrame(
                {
                    "lang": frame["lang"][keep],
                    "bits": [
                        np.packbits(_slots(t)).tobytes() for t, k in zip(texts, keep, strict=True) if k
                    ],
                }
            )

    draw = F.xxhash64("doc_id", "lang")
    known = labelled.where("lang is not null and text is not null")
    # Draws are even over 64 bits: a share of four samples holds the smallest ones, and only these
    # few rows are sorted, whatever the number of tasks.
    share = min(1.0, 4 * sample / max(1, known.count()))
    known = known.where(draw <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
    drawn = (
        known.select("lang", "text", draw.alias("draw"), F.xxhash64("text").alias("tie"))
        .orderBy("draw", "tie", "lang")
        .limit(sample)
    )
    rows = drawn.select("lang", "text").mapInPandas(bits, "lang string, bits binary").collect()
    rows.sort(key=lambda r: (r["bits"], r["lang"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((SLOTS, 0), np.float32), np.zeros(0))

    def dense(some: list) -> object:
        packed = np.frombuffer(b"".join(r["bits"] for r in some), dtype=np.uint8)
        out = np.unpackbits(packed.reshape(len(some), -1), axis=1).astype(np.float32)
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    spread = np.linspace(0, len(rows) - 1, min(landmarks, len(rows))).astype(int)
    by_language = sorted(range(len(rows)), key=lambda i: (rows[i]["lang"], rows[i]["bits"]))
    marks = dense([rows[by_language[i]] for i in spread])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    solid = values > 1e-6 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])
    gram = np.zeros((root.shape[1] + 1,) * 2)
    answers = np.zeros((root.shape[1] + 1, len(languages)))
    having = np.zeros((len(languages), SLOTS), dtype=np.int64)
    for at in range(0, len(rows), _ROWS):
        some = rows[at : at + _ROWS]
        given = dense(some)
        features = (given @ marks.T).astype(np.float64) @ root
        features = np.hstack([features, np.ones((len(some), 1))])
        wanted = np.array([[1.0 if r["lang"] == c else -1.0 for c in languages] for r in some])
        gram += features.T @ features
        answers += features.T @ wanted
        having += (wanted > 0).astype(np.int64).T @ (given > 0)
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), answers)
    weights = marks.T @ (root @ solved[:-1])
    drawn_of = np.array([[sum(r["lang"] == c for r in rows)] for c in languages])
    familiar = (having >= np.maximum(1, FAMILIAR_ROWS * drawn_of)).any(axis=0)
    return LanguageModel(languages, weights.astype(np.float32), solved[-1].astype(np.float32), familiar)


def in_holdout(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """True for the rows that are never learnt from; false for a null id."""
    text = F.encode(doc_id.cast("string"), "UTF-8")
    return F.coalesce(F.crc32(text) % folds == fold, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and lang_score for every whole text, in place of any such columns.

    Null texts and texts without a letter are ``und`` with score 0; so is everything under a model
    that knows no language. Only the text is read. The model is sent once to each executor; its
    size is ``SLOTS`` times the number of languages in the sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = [None if t is None else str(t) for t in texts]
            yield pd.DataFrame(shared.value.predict(known), columns=["lang_pred", "lang_score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    row = docs.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), F.col("text").alias("text"))
    return row.select("row", predict("text").alias("found")).select("row.*", "found.*")


def keep_known(docs: DataFrame, least: float = 0.25, familiar: float = MIN_FAMILIAR) -> DataFrame:
    """``docs`` without rows whose language can't be told.

    Those are texts without a letter, those with a score under ``least``, and those of whose n-grams
    a share under ``familiar`` is known from the sampled rows of any language. The best score alone
    rejects next to nothing: scores of all languages add up to about 1, so the best is at least one
    over their number. The model learns from the labelled rows of ``docs`` outside the holdout.
    Columns unchanged. If no row has a label, nothing can be told and only rows without a letter go.
    """
    model = fit(docs.where(~in_holdout(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            told = shared.value.tell([None if t is None else str(t) for t in texts])
            yield pd.Series(
                [name != UNDETERMINED and score >= least and share >= familiar for name, score, share in told],
                dtype=bool,
            )

    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return row.where(known("text")).select("row.*")
