from pyspark.sql import functions as F

from support import SF_SMALL
from docloom.sources import fixtures as fx
from docloom.sources.tables import load_table


def test_pages_bound_document_size(spark):
    """A group larger than the page size is split, nothing is lost, and no
    page is far above the bound."""
    o = load_table(spark, SF_SMALL, "orders").withColumn("g", F.lit(1))  # one hot group
    pages = fx.nest_pages(o, ["g"], F.col("o_orderkey"), F.col("o_orderkey"),
                          F.col("o_orderkey").cast("string"), page_size=100)
    rows = pages.collect()
    n = o.count()
    assert sum(r.n_items for r in rows) == n
    assert len(rows) == -(-n // 100)
    assert max(r.n_items for r in rows) <= 150


def test_all_fixture_documents_parse(spark):
    for build in (fx.day_docs, fx.board_docs, fx.event_docs, fx.group_docs, fx.roster_docs,
                  fx.stat_docs, fx.tx_docs):
        d = build(spark, SF_SMALL)
        assert d.where(F.try_parse_json("body").isNull()).count() == 0, build.__name__
