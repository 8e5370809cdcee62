"""Quality scores by compression: texts are compressed with a zstandard dictionary built from good labelled text and with
one built from bad labelled text, and the normalised difference of the sizes becomes a calibrated score.

Method. Texts are cut into pieces of ``PIECE`` bytes (whole text, no prefix), so the dictionary counts alike in long and
short ones. Each piece is compressed with each dictionary; the evidence is ``(size with bad - size with good)`` summed over
the pieces, divided by the number of bytes. A logistic calibration on a fold of the sample that built no dictionary turns
it into the chance of label 1.

Training reads a bounded sample of labelled rows (``per_class`` of each class, never held-out ones), in one task a class;
the dictionaries (``DICTIONARY`` bytes each, fixed) are broadcast. Scoring is one pass over Arrow batches without a shuffle.

Defined cases: null text counts as empty; an empty text has evidence 0; without labels of both classes every text gets
the share of label 1; repeated rows, null ids and other columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labels import PER_CLASS, calibrate, chance, held_out, labelled_sample
from ._text import small_batches

PIECE = 2048
DICTIONARY = 64 << 10
LEVEL = 3
THRESHOLD = 0.3


def pieces(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def build(texts: list[str]) -> bytes:
    """A dictionary of at most ``DICTIONARY`` bytes; without enough text to train one, the pieces themselves."""
    samples = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class Evidence:
    def __init__(self, bad: bytes, good: bytes) -> None:
        self.by = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d), level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
            ).compress
            for d in (bad, good)
        ]

    def __call__(self, text: str) -> float:
        bad, good = self.by
        parts = pieces(text)
        return sum(len(bad(p)) - len(good(p)) for p in parts) / max(1, sum(map(len, parts)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """``(dictionary of bad text, of good text, calibration)``. Fold 0 of the sample is for the calibration only."""
    sample, share = labelled_sample(docs, labels, "quality", per_class)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        return pd.DataFrame({"y": [pdf["y"].iloc[0]], "dictionary": [build(pdf["text"].tolist())]})

    built = {r.y: bytes(r.dictionary) for r in sample.where("fold > 0").groupBy("y").applyInPandas(one, "y int, dictionary binary").collect()}
    bad, good = built.get(0, b""), built.get(1, b"")

    def rest(pdf: pd.DataFrame) -> pd.DataFrame:
        evidence = Evidence(bad, good)
        return pd.DataFrame({"z": [evidence(t) for t in pdf["text"]], "y": pdf["y"].to_numpy()})

    found = sample.where("fold = 0").groupBy("fold").applyInPandas(rest, "z double, y int").toPandas()  # of the bounded sample
    return bad, good, calibrate(found["z"].to_numpy(float), found["y"].to_numpy(int), share)


def compression_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, per_class))

    def run(batches):
        bad, good, ab = model.value
        evidence = Evidence(bad, good)
        for b in batches:
            score = chance(np.array([evidence(t or "") for t in b.column("text").to_pylist()], float), ab)
            cols = [b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, schema)
