"""Language identification with calibrated rejection.

The classifier of `subword` learns from a bounded sample of labelled rows: about PER_CLASS documents of each language
(chosen by a hash of doc_id, of at most LONGEST bytes each, ROWS in all).  Predictions read every whole text.

Edge cases: a null text or one without letters is `und` with score 0 and is rejected; a null lang is not learned from;
with no labelled row at all every text is `und`; repeated rows and ties get equal predictions (the first class in
alphabetical order wins a tie).  Columns of the input beside doc_id and text never matter to a prediction.

Rejected are texts without letters, of a confidence near chance, and of which too few n-grams are known from training (`subword`): other
scripts and languages, code, noise.  A rejected text with letters still carries the nearest language in `lang_pred`; `rejected` is a column of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import tune
from .subword import Model, train

PER_CLASS = 300
ROWS = 2400
LONGEST = 1 << 16
UNKNOWN = "und"


def fold(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % 4


def bounded_sample(rows: DataFrame, label: str, text: str, key: str, per_class: int = PER_CLASS, at_most: int = ROWS) -> list[tuple[str, str]]:
    """(text, label) of about `per_class` rows of each class, fewer if there are many.  Chosen by a hash of the key alone; `at_most` cuts all classes alike.

    Texts of over LONGEST bytes are not learned from: the driver holds at most `at_most` * LONGEST bytes.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(at_most).collect()}
    if not sizes:
        return []
    of, per_class = 1 << 20, min(per_class, at_most // len(sizes))
    share = F.create_map(*(x for c, n in sizes.items() for x in (F.lit(c), F.lit(min(of, -(-of * per_class // n))))))
    code = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(17)), F.lit(of))
    part = share[F.col(label)]
    picked = rows.where((code < part) & (F.octet_length(text) <= LONGEST)).select((code / part).alias("rank"), code.alias("code"), F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    return [(r.text, r.label) for r in picked.orderBy("rank", "key", "text", "label").limit(at_most).orderBy("code", "key", "text", "label").collect()]


def fit(docs: DataFrame, held_out_fold: int | None = 2) -> Model:
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    if held_out_fold is not None:
        learn = learn.where(fold() != held_out_fold)
    sample = bounded_sample(learn, "lang", "text", "doc_id")
    return train([t for t, _ in sample], [c for _, c in sample])


def predict(model: Model) -> callable:
    """Column function text -> struct(lang_pred, score, rejected)."""

    def one(text):
        if not text or not model.classes or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        p, hits, of = model.read(text)
        best = int(np.argmax(p))
        return model.classes[best], float(p[best]), bool(p[best] < model.reject_below or model.foreign(hits, of))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x) for x in text], columns=["lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row."""
    tune(docs.sparkSession)
    model = model or fit(docs)
    made = docs.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), predict(model)(F.col("text")).alias("p"))
    return made.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows whose language is not rejected, with the columns of `docs`."""
    tune(docs.sparkSession)
    model = model or fit(docs)
    return docs.where(~predict(model)(F.col("text"))["rejected"])
