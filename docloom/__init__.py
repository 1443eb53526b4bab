"""docloom: nested-document ingestion and analytics on Spark.

Documents (one JSON body per row) are parsed into VARIANT, sliced by path,
chained to other document sets by key, stamped with load metadata, flattened
into parent/child tables, and loaded append / replace / upsert.  Everything is
expressed with DataFrame, SQL and VARIANT functions.

Main entry points::

    from docloom.session import get_session
    from docloom.plans.run import run_load                 # one load run
    from docloom.operators.flatten import flatten          # O17 / O18
    from docloom.operators.nested import path_rows, extract_keys, stamp
    from docloom.operators.chain import chain
    from docloom.operators import load                     # append / replace / merge
    from docloom.streaming import start_ingest             # incremental loads
"""

__version__ = "0.1.0"
