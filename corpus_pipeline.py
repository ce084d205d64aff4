"""A training-data pipeline over ``documents``: each stage reads what the one before it wrote.

Toxic documents go; of each group of near duplicates one stays; secrets are replaced;
sources are laid out in the order of their target weights; and texts become tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textgraph.llm.bpe import encode_documents
from textgraph.llm.jaccard import one_of_each
from textgraph.llm.mixing import in_mixed_order
from textgraph.llm.secrets import redact_secrets
from textgraph.llm.tables import table
from textgraph.llm.toxicity import drop_toxic
from textgraph.scratch import cut_lineage

STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", one_of_each),
    ("secrets", redact_secrets),
    ("mixing", in_mixed_order),
    ("bpe", encode_documents),
]

# A learnt classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage before it keeps is written as a table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
