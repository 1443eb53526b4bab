"""Shared by the test modules (fixtures live in conftest.py)."""

SF_SMALL = "/root/testdata/sf0.001"


def docs_df(spark, rows, context=("k",)):
    """Rows of (context..., json text) -> DataFrame with ``doc`` VARIANT."""
    from docloom.operators.nested import parse_documents
    cols = list(context) + ["body"]
    return parse_documents(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)), "body", "doc")
