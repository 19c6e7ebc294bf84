"""Write records as raw envelope files: ``{"movie": [...]}`` documents, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_envelope(records: DataFrame, path: str, key: str = "movie") -> None:
    """Each record as an envelope of its own, one per line (JSON lines).

    The text is rendered in the JVM (``to_json``), so a record reads back as
    ``to_json`` gives it. No shuffle, no group, no Python.
    """
    one = F.concat(F.lit('{"%s":[' % key), F.to_json(F.struct(*records.columns)), F.lit("]}"))
    records.select(one.alias("value")).write.mode("errorifexists").text(path)


def write_envelope_documents(records: DataFrame, path: str, key: str = "movie",
                             records_per_file: int = 5000) -> None:
    """Envelopes of many records, each document its own file (the multi-line layout).

    Documents are cut from consecutive rows of one Arrow batch, at most
    ``records_per_file`` each, by a string join in the task: no shuffle and no
    group that grows with the data. A retried task re-forms the documents of
    its own partition.
    """
    texts = records.select(F.to_json(F.struct(*records.columns)).alias("r"))
    head, tail, n = '{"%s":[' % key, "]}", int(records_per_file)

    def documents(batches):
        import pandas as pd

        for pdf in batches:
            r = pdf["r"].dropna().tolist()
            yield pd.DataFrame({"value": [head + ",".join(r[i:i + n]) + tail
                                          for i in range(0, len(r), n)]})

    (texts.mapInPandas(documents, "value STRING").write.mode("errorifexists")
     .option("maxRecordsPerFile", 1).text(path))
