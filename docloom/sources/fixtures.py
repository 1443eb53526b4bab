"""Document sets built from the driver's flat tables.

They play the parts of the API responses the pipeline lands (scoreboard per
day, game summary per event, teams, rosters, standings, transactions), so
every document operator can be checked against flat SQL on the same tables.

Documents are grouped from many rows, so each builder bounds its groups: a
group (one day, one order, one nation ...) is split into pages of at most
about ``page_size`` items (``nest_pages``).  A key holding a third of all rows
becomes many documents -- like a paginated response -- never one task-sized
array.  Items inside a page are sorted, so positions are deterministic.

JSON is assembled as text from typed columns: this keeps exact control of
edge cases (missing key vs explicit null, id as "0" / 0 / "" / false / {}).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.dates import season_end_year
from docloom.sources.tables import load_table

# Fixed values of the documented API (status codes and names, uid prefix).
STATUS_BY_ID = {
    "1": ("STATUS_SCHEDULED", "pre", "Scheduled"),
    "2": ("STATUS_IN_PROGRESS", "in", "In Progress"),
    "3": ("STATUS_FINAL", "post", "Final"),
}
UID_PREFIX = "s:40~l:46"
# Return flags of lineitem, each playing one team of a game summary.
TEAM_FLAGS = ("A", "N", "R")

# Page sizes (items per document).
EVENTS_PER_DOC = 1000
LINES_PER_DOC = 500
COMPETITORS_PER_EVENT = 64
TEAMS_PER_DOC = 1000
ATHLETES_PER_DOC = 1000
ENTRIES_PER_DOC = 1000
TX_PER_DOC = 1000
ARTICLES_PER_DOC = 100


# ---------------------------------------------------------------- JSON text
def jstr(c: Column) -> Column:
    """JSON string literal (escaped), or 'null'."""
    a = F.to_json(F.array(c))
    return F.substring(a, F.lit(2), F.length(a) - 2)


def jnum(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def jbool(c: Column) -> Column:
    return F.when(c, F.lit("true")).when(~c, F.lit("false")).otherwise(F.lit("null"))


def kv(key: str, json_value: Column) -> Column:
    """'"key":value' -- a NULL value drops the key entirely (missing)."""
    return F.concat(F.lit(f'"{key}":'), json_value)


def jobj(*pairs: Column) -> Column:
    """Object from kv() pairs; NULL pairs are skipped by concat_ws."""
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def jarr_of(items_json: Column) -> Column:
    """ARRAY<STRING> of JSON values -> JSON array text."""
    return F.concat(F.lit("["), F.array_join(items_json, ","), F.lit("]"))


def iso_minutes(ts: Column) -> Column:
    """Instant text in the short API form, e.g. 2024-10-25T23:00Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'")


def zpad(c: Column) -> Column:
    """A non-negative integer as 20-digit text (sorts like the number)."""
    return F.lpad(c.cast("string"), 20, "0")


def packed_key(*parts: Column) -> Column:
    """One string that sorts like the tuple of ``parts`` (each part must be
    fixed-width or ``zpad``-ed).  Sorting one string is much cheaper than
    comparing a wide struct inside ``array_sort``."""
    return F.concat_ws("\u0001", *parts)


# -------------------------------------------------------------- paging
def row_hash(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def _field(name: str):
    return lambda x: x[name]


def nest_pages(df: DataFrame, group_cols: list[str], page_key: Column, sort_key: Column,
               items: Column | dict[str, Column], page_size: int,
               aggs: list[Column] | None = None) -> DataFrame:
    """Group items into documents of bounded size.

    Returns ``group_cols + [page, n_items, <item arrays>, <aggs>]``: one JSON
    array text per entry of ``items`` (a single Column gives ``items``), each
    sorted by ``sort_key``, plus optional typed aggregates of the page.  The
    number of pages of a group is ceil(count / page_size); a row goes to page
    ``pmod(page_key, pages)``; ``page_key`` must tell the rows of a group apart
    (a unique key, or ``row_hash`` of the whole sort key).

    Counting is a partial (map-side) aggregate.  Only groups of more than one page
    need their count: at most a row per ``page_size`` rows, broadcast.  So the rows
    are shuffled once, by (group, page) -- a hot group lies in many tasks -- and
    as they are read: their JSON text, several times larger, is made behind the shuffle.
    """
    if isinstance(items, Column):
        items = {"items": items}
    names = list(items)
    large = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > page_size).select(
        *[F.col(c).alias(f"_g_{c}") for c in group_cols], "_n")
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]  # a NULL group is a group
    page = F.when(page_key.isNull(), F.lit(None)).when(F.col("_n").isNull(), F.lit(0)) \
        .otherwise(F.pmod(page_key, F.ceil(F.col("_n") / F.lit(page_size))))
    paged = df.join(F.broadcast(large), same, "left").withColumn("page", page.cast("int")).drop(
        "_n", *[f"_g_{c}" for c in group_cols])
    rows = paged.repartition(*group_cols, "page").withColumn("_sk", sort_key).withColumns(
        {f"_js_{n}": items[n] for n in names})
    grouped = rows.groupBy(*group_cols, "page").agg(
        F.sort_array(F.collect_list(F.struct("_sk", *[f"_js_{n}" for n in names]))).alias("_items"),
        *(aggs or []))
    extra = [c for c in grouped.columns if c not in (*group_cols, "page", "_items")]
    return grouped.select(
        *group_cols, "page", F.size("_items").alias("n_items"),
        *[jarr_of(F.transform("_items", _field(f"_js_{n}"))).alias(n) for n in names],
        *extra)


# -------------------------------------------------------------- events
def _status_obj(status_id: Column) -> Column:
    name = F.create_map(*[x for k, v in STATUS_BY_ID.items() for x in (F.lit(k), F.lit(v[0]))])
    state = F.create_map(*[x for k, v in STATUS_BY_ID.items() for x in (F.lit(k), F.lit(v[1]))])
    desc = F.create_map(*[x for k, v in STATUS_BY_ID.items() for x in (F.lit(k), F.lit(v[2]))])
    return jobj(kv("type", jobj(
        kv("id", jstr(status_id)),
        kv("name", jstr(name[status_id])),
        kv("state", jstr(state[status_id])),
        kv("completed", jbool(status_id == "3")),
        kv("description", jstr(desc[status_id])))))


def status_id_of(orderstatus: Column) -> Column:
    """Fixture rule: order status O/P/F plays scheduled/in progress/final."""
    return F.when(orderstatus == "O", "1").when(orderstatus == "P", "2") \
        .when(orderstatus == "F", "3")


def event_id_json(orderkey: Column, orderstatus: Column, priority: Column) -> Column:
    """Fixture rule for the event id's JSON form (NULL = key missing).

    Status F/O: a string id for priorities 1, 3, 5 and a number id for 2, 4.
    Status P: falsy forms -- 1-URGENT {}, 2-HIGH false, 3-MEDIUM missing,
    4-NOT SPECIFIED "", 5-LOW null.
    """
    k = orderkey.cast("string")
    return (F.when((orderstatus != "P") & priority.isin("2-HIGH", "4-NOT SPECIFIED"), k)
            .when(orderstatus != "P", jstr(k))
            .when(priority == "1-URGENT", F.lit("{}"))
            .when(priority == "2-HIGH", F.lit("false"))
            .when(priority == "3-MEDIUM", F.lit(None).cast("string"))
            .when(priority == "4-NOT SPECIFIED", F.lit('""'))
            .otherwise(F.lit("null")))


def _day_payload(day: Column, season: Column, events_json: Column) -> Column:
    """Scoreboard document body.  Fixture rule for a payload key that clashes
    with the stamped ``date``: February documents carry ``"date": null``,
    March documents ``"date": "<yyyy-MM-dd>"``, others no such key."""
    m = F.month(day)
    clash = F.when(m == 2, kv("date", F.lit("null"))) \
        .when(m == 3, kv("date", jstr(F.date_format(day, "yyyy-MM-dd"))))
    return jobj(
        kv("leagues", F.lit('[{"abbreviation":"NBA"}]')),
        kv("events", events_json),
        kv("day", jobj(kv("date", jstr(F.date_format(day, "yyyy-MM-dd"))))),
        kv("season", jobj(kv("year", jnum(season)), kv("type", F.lit("2")))),
        clash)


def day_docs(spark: SparkSession, sf_dir: str, page_size: int = EVENTS_PER_DOC, day=None) -> DataFrame:
    """Scoreboard per day (from orders): ``resource, date, page, body``.

    Events: id (see ``event_id_json``), uid, date, name, shortName, status,
    total, competitions (one: id, date, two flags, venue).  Events of a page are sorted by order key.
    """
    o = load_table(spark, sf_dir, "orders")
    if day is not None:  # a range on the raw column, so it reaches the scan
        o = o.where((F.col("o_orderdate") >= F.lit(day)) & (F.col("o_orderdate") < F.date_add(F.lit(day), 1)))
    ev = jobj(kv("id", event_id_json(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"))),
              kv("uid", jstr(F.concat(F.lit(UID_PREFIX + "~e:"), F.col("o_orderkey").cast("string")))),
              kv("date", jstr(iso_minutes(F.col("o_orderdate")))),
              kv("name", jstr(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"),
                                       F.lit(" at Order "), F.col("o_orderkey").cast("string")))),
              kv("shortName", jstr(F.col("o_orderpriority"))),
              kv("status", _status_obj(status_id_of(F.col("o_orderstatus")))),
              kv("total", jnum(F.col("o_totalprice"))),
              kv("competitions", jarr_of(F.array(jobj(
                  kv("id", jstr(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")))),
                  kv("date", jstr(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))),
                  kv("neutralSite", jbool(F.col("o_orderstatus") == "P")),
                  kv("conferenceCompetition", jbool(F.col("o_custkey") % 2 == 0)),
                  kv("venue", jobj(kv("fullName", jstr(F.concat(F.lit("Arena "), F.col("o_custkey").cast("string"))))))
              )))))
    pages = nest_pages(o.withColumn("day", F.to_date("o_orderdate")), ["day"], F.col("o_orderkey"),
                       F.col("o_orderkey"), ev, page_size)
    return pages.select(
        F.lit("scoreboard").alias("resource"),
        F.date_format("day", "yyyyMMdd").alias("date"),
        "page",
        _day_payload(F.col("day"), season_end_year(F.col("day")), F.col("items")).alias("body"))


def board_docs(spark: SparkSession, sf_dir: str, page_size: int = EVENTS_PER_DOC,
               competitors_per_event: int = COMPETITORS_PER_EVENT) -> DataFrame:
    """Scoreboard per day with ``competitions[0].competitors`` (from orders and
    lineitem): odd lines play home, even lines away; team = supplier; score = the
    quantity as text; linescores = quantity, discount and tax in points,
    line number.  An order's competitor list is itself paged, and each page
    is one event entry of the day (same id, like a repeated listing)."""
    o = load_table(spark, sf_dir, "orders")
    li = load_table(spark, sf_dir, "lineitem")
    comp = li.select(
        "l_orderkey",
        F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount",
                 "l_tax").alias("sk"),
        F.to_json(F.struct(
            F.col("l_suppkey").cast("string").alias("id"),
            F.when(F.col("l_linenumber") % 2 == 1, "home").otherwise("away").alias("homeAway"),
            F.col("l_quantity").cast("int").cast("string").alias("score"),
            F.struct(F.col("l_suppkey").cast("string").alias("id"),
                     F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("displayName"))
             .alias("team"),
            F.array(*[F.struct(v.cast("int").alias("value")) for v in (
                F.col("l_quantity"), F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100),
                F.col("l_linenumber"))]).alias("linescores"))).alias("cj"))
    comps = nest_pages(comp, ["l_orderkey"], row_hash(F.col("sk")), F.col("sk"), F.col("cj"),
                       competitors_per_event)
    ev = o.join(comps, o.o_orderkey == comps.l_orderkey, "left").select(
        F.to_date("o_orderdate").alias("day"),
        F.col("o_orderkey"),
        F.struct(F.col("o_orderkey"), F.coalesce("page", F.lit(0))).alias("sk"),
        jobj(kv("id", jstr(F.col("o_orderkey").cast("string"))),
             kv("uid", jstr(F.concat(F.lit(UID_PREFIX + "~e:"), F.col("o_orderkey").cast("string")))),
             kv("date", jstr(iso_minutes(F.col("o_orderdate")))),
             kv("name", jstr(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")))),
             kv("status", _status_obj(status_id_of(F.col("o_orderstatus")))),
             kv("competitions", F.when(F.col("items").isNotNull(), jarr_of(F.array(jobj(
                 kv("id", jstr(F.col("o_orderkey").cast("string"))),
                 kv("venue", jobj(kv("fullName", jstr(F.concat(F.lit("Arena "),
                                                               F.col("o_custkey").cast("string")))))),
                 kv("competitors", F.col("items")))))))).alias("ev"))
    pages = nest_pages(ev, ["day"], F.col("o_orderkey"), F.col("sk"), F.col("ev"), page_size)
    return pages.select(
        F.lit("scoreboard").alias("resource"),
        F.date_format("day", "yyyyMMdd").alias("date"),
        "page",
        jobj(kv("events", F.col("items")),
             kv("day", jobj(kv("date", jstr(F.date_format("day", "yyyy-MM-dd")))))).alias("body"))


def event_docs(spark: SparkSession, sf_dir: str, page_size: int = LINES_PER_DOC,
               only: DataFrame | None = None) -> DataFrame:
    """Game summary per event (order) with its line items: ``resource,
    event_id, page, body``.  Orders without line items have no summary.

    Body: ``header.id``; ``lines[]`` (n, part, supp, qty, price, disc, tax,
    flag, status, ship); ``boxscore.teams[]`` -- one team per return flag with
    statistics ``quantityMade-quantityAttempted`` ("made-attempted" text),
    ``lines`` and ``netMargin`` (decimal, may be negative);
    ``boxscore.players[]``: two sides (odd lines, even lines), each with a
    statistics group of parallel arrays ``labels`` and per-athlete ``stats``
    (line 7 has one stat fewer, line 6 one more than there are labels);
    ``playerStats[]`` with name/value lists; ``gameInfo`` with attendance (total quantity) and ``officials[]`` (one per
    line: the supplier, ordered by line number).  ``only`` (o_orderkey) limits
    the documents to the events that are asked for, before anything is built."""
    li = load_table(spark, sf_dir, "lineitem")
    if only is not None:
        li = li.join(only.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    # Order of lines: line number, part, then the line's JSON text (a total
    # order, so positions are deterministic with a cheap sort key).
    sk = F.struct("l_linenumber", "l_partkey")
    line = F.to_json(F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship")))
    qty = F.col("l_quantity").cast("int")
    tax = F.round(F.col("l_tax") * 100).cast("int")
    minutes = F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(":"),
                       F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"))
    signed = F.concat(F.when(tax >= 0, F.lit("+")).otherwise(F.lit("")), tax.cast("string"))
    stats = F.slice(F.array(
        qty.cast("string"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("-"), qty.cast("string")),
        signed, minutes, F.lit("extra")),
        1, F.when(F.col("l_linenumber") == 7, 3).when(F.col("l_linenumber") == 6, 5).otherwise(4))
    who = F.struct(F.col("l_partkey").cast("string").alias("id"),
                   F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("displayName"))
    athlete = F.to_json(F.struct(who.alias("athlete"), stats.alias("stats")))
    odd = F.col("l_linenumber") % 2 == 1
    clock, *rest = [F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in (
        ("minutes", minutes), ("points", qty.cast("string")), ("plusMinus", signed))]
    named = F.to_json(F.struct(
        who.alias("athlete"),
        F.struct(F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("displayName")).alias("team"),
        F.when(F.col("l_linenumber") != 7, F.array(clock, *rest)).otherwise(F.array(*rest)).alias("stats")))
    q = F.col("l_quantity").cast("bigint")
    aggs = [F.sum(q).alias("_tot")]
    margin = F.round(F.col("l_quantity") * (F.col("l_tax") - F.col("l_discount")) * 100)
    for f in TEAM_FLAGS:
        aggs.append(F.coalesce(F.sum(F.when(F.col("l_returnflag") == f, margin.cast("bigint"))), F.lit(0))
                    .alias(f"_margin_{f}"))
        aggs += [F.coalesce(F.sum(F.when(F.col("l_returnflag") == f, q)), F.lit(0)).alias(f"_made_{f}"),
                 F.count(F.when(F.col("l_returnflag") == f, 1)).alias(f"_lines_{f}")]
    official = F.to_json(F.struct(
        F.concat(F.lit("Official "), F.col("l_suppkey").cast("string")).alias("displayName"),
        F.col("l_linenumber").alias("order")))
    pages = nest_pages(li, ["l_orderkey"], row_hash(F.col("l_linenumber"), F.col("l_partkey"), line), sk,
                       {"lines": line, "home": F.when(odd, athlete), "away": F.when(~odd, athlete),
                        "named": named, "officials": official}, page_size, aggs)
    teams = F.to_json(F.array(*[F.struct(
        F.struct(F.lit(f).alias("abbreviation")).alias("team"),
        F.array(
            F.struct(F.lit("quantityMade-quantityAttempted").alias("name"),
                     F.concat(F.col(f"_made_{f}").cast("string"), F.lit("-"),
                              F.col("_tot").cast("string")).alias("displayValue")),
            F.struct(F.lit("lines").alias("name"),
                     F.col(f"_lines_{f}").cast("string").alias("displayValue")),
            F.struct(F.lit("netMargin").alias("name"),
                     (F.col(f"_margin_{f}") / 100).cast("decimal(20,2)").cast("string").alias("displayValue")))
        .alias("statistics"))
        for f in TEAM_FLAGS]))
    players = F.concat(F.lit("["), *[x for side, sep in (("home", ","), ("away", "")) for x in (
        F.lit(f'{{"side":"{side}","statistics":[{{"labels":["PTS","FG","+/-","MIN"],"athletes":'),
        F.col(side), F.lit("}]}" + sep))], F.lit("]"))
    return pages.select(
        F.lit("game_summary").alias("resource"),
        F.col("l_orderkey").cast("string").alias("event_id"),
        "page",
        jobj(kv("header", jobj(kv("id", jstr(F.col("l_orderkey").cast("string"))))),
             kv("lines", F.col("lines")),
             kv("boxscore", jobj(kv("teams", teams), kv("players", players))),
             kv("playerStats", F.col("named")),
             kv("gameInfo", jobj(kv("attendance", jnum(F.col("_tot"))),
                                 kv("officials", F.col("officials"))))).alias("body"))


def group_docs(spark: SparkSession, sf_dir: str, page_size: int = TEAMS_PER_DOC) -> DataFrame:
    """Teams response per region: ``{sports:[{leagues:[{teams:[{team:{id,
    uid, displayName, abbreviation}}]}, {teams:[...decoys...]}]}, {...}]}``.

    Only ``sports[0].leagues[0]`` is real; the second league and second sport
    hold decoy teams (id prefixed 'x') that a correct reader never returns.
    Fixture rule: the team of nation 0 has the falsy *number* id 0; all
    other ids are strings."""
    n = load_table(spark, sf_dir, "nation")
    r = load_table(spark, sf_dir, "region")
    k = F.col("n_nationkey").cast("string")
    team = jobj(kv("team", jobj(
        kv("id", F.when(F.col("n_nationkey") == 0, F.lit("0")).otherwise(jstr(k))),
        kv("uid", jstr(F.concat(F.lit(UID_PREFIX + "~t:"), k))),
        kv("displayName", jstr(F.col("n_name"))),
        kv("abbreviation", jstr(F.substring("n_name", 1, 3))))))
    decoy = jobj(kv("team", jobj(kv("id", jstr(F.concat(F.lit("x"), k))))))
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    real = nest_pages(nr, ["r_regionkey", "r_name"], F.col("n_nationkey"), F.col("n_nationkey"),
                      team, page_size)
    fake = nest_pages(nr, ["r_regionkey", "r_name"], F.col("n_nationkey"), F.col("n_nationkey"),
                      decoy, page_size).select("r_regionkey", "page", F.col("items").alias("decoys"))
    d = real.join(fake, ["r_regionkey", "page"])
    league = lambda teams: jobj(kv("teams", teams))
    return d.select(
        F.lit("teams").alias("resource"),
        F.col("r_regionkey").cast("string").alias("region"),
        "page",
        jobj(kv("sports", F.concat(
            F.lit("["),
            jobj(kv("name", jstr(F.col("r_name"))),
                 kv("leagues", F.concat(F.lit("["), league(F.col("items")), F.lit(","),
                                        league(F.col("decoys")), F.lit("]")))),
            F.lit(","),
            jobj(kv("name", F.lit('"decoy"')),
                 kv("leagues", F.concat(F.lit("["), league(F.col("decoys")), F.lit("]")))),
            F.lit("]")))).alias("body"))


def roster_docs(spark: SparkSession, sf_dir: str, page_size: int = ATHLETES_PER_DOC) -> DataFrame:
    """Roster per team (nation) from customers: ``resource, team_id, page,
    body``; athletes carry injuries[] (negative balance -> one injury) and
    contracts[] (one per market segment letter pair)."""
    c = load_table(spark, sf_dir, "customer")
    ath = jobj(
        kv("id", jstr(F.col("c_custkey").cast("string"))),
        kv("displayName", jstr(F.col("c_name"))),
        kv("position", jobj(kv("abbreviation", jstr(F.col("c_mktsegment"))))),
        kv("salary", jnum(F.col("c_acctbal"))),
        kv("injuries", F.when(F.col("c_acctbal") < 0, jarr_of(F.array(jobj(
            kv("status", F.lit('"Out"')),
            kv("type", jstr(F.col("c_mktsegment")))))))
           .otherwise(F.lit("[]"))),
        kv("contracts", jarr_of(F.array(
            jobj(kv("season", F.lit("2024")), kv("salary", jnum(F.col("c_acctbal")))),
            jobj(kv("season", F.lit("2025")), kv("salary", jnum(F.round(F.col("c_acctbal") * 2, 2))))))))
    pages = nest_pages(c, ["c_nationkey"], F.col("c_custkey"), F.col("c_custkey"), ath, page_size)
    k = F.col("c_nationkey").cast("string")
    return pages.select(
        F.lit("rosters").alias("resource"),
        k.alias("team_id"),
        "page",
        jobj(kv("team", jobj(kv("id", jstr(k)))),
             kv("season", jobj(kv("year", F.lit("2025")))),
             kv("athletes", F.col("items"))).alias("body"))


def stat_docs(spark: SparkSession, sf_dir: str, page_size: int = ENTRIES_PER_DOC) -> DataFrame:
    """Standings per region: ``children[0].standings.entries[]`` = one entry
    per customer of the region with stats wins (F orders), losses (O orders)
    and winPercent (omitted when the customer has neither).  ``children[1]``
    holds the same entries under another group name."""
    c = load_table(spark, sf_dir, "customer")
    o = load_table(spark, sf_dir, "orders")
    n = load_table(spark, sf_dir, "nation")
    per = o.groupBy("o_custkey").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("w"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("l"))
    cc = c.join(n, c.c_nationkey == n.n_nationkey) \
        .join(per, c.c_custkey == per.o_custkey, "left") \
        .select("c_custkey", "c_name", "n_regionkey",
                F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("l", F.lit(0)).alias("l"))
    pct = F.when(F.col("w") + F.col("l") > 0, F.round(F.col("w") / (F.col("w") + F.col("l")), 3))
    entry = jobj(
        kv("team", jobj(kv("id", jstr(F.col("c_custkey").cast("string"))),
                        kv("displayName", jstr(F.col("c_name"))))),
        kv("stats", jarr_of(F.filter(F.array(
            jobj(kv("name", F.lit('"wins"')), kv("value", jnum(F.col("w")))),
            jobj(kv("name", F.lit('"losses"')), kv("value", jnum(F.col("l")))),
            F.when(pct.isNotNull(), jobj(kv("name", F.lit('"winPercent"')), kv("value", jnum(pct))))),
            lambda x: x.isNotNull()))))
    pages = nest_pages(cc, ["n_regionkey"], F.col("c_custkey"), F.col("c_custkey"), entry, page_size)
    group = lambda name: jobj(kv("name", F.lit(f'"{name}"')),
                              kv("standings", jobj(kv("entries", F.col("items")))))
    return pages.select(
        F.lit("standings").alias("resource"),
        F.col("n_regionkey").cast("string").alias("region"),
        "page",
        jobj(kv("children", F.concat(F.lit("["), group("Conference"), F.lit(","),
                                     group("Decoy"), F.lit("]")))).alias("body"))


def tx_docs(spark: SparkSession, sf_dir: str, page_size: int = TX_PER_DOC) -> DataFrame:
    """Transactions per supplier (from lineitem): ``{count, transactions:[{date,
    description, team?}]}`` sorted by date; the team object is omitted for
    returned lines (flag 'R')."""
    li = load_table(spark, sf_dir, "lineitem")
    # Rows equal on all of these render the same JSON, so the order is total.
    sk = packed_key(F.date_format("l_shipdate", "yyyyMMddHHmmss"), zpad(F.col("l_orderkey")),
                    zpad(F.col("l_linenumber")), zpad(F.col("l_partkey")),
                    zpad(F.col("l_quantity").cast("int")), F.col("l_returnflag"))
    # to_json drops NULL fields, so returned lines get no "team" key at all.
    tx = F.to_json(F.struct(
        iso_minutes(F.col("l_shipdate")).alias("date"),
        F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(" line "),
                 F.col("l_linenumber").cast("string"), F.lit(": "),
                 F.col("l_quantity").cast("int").cast("string"), F.lit(" x part "),
                 F.col("l_partkey").cast("string")).alias("description"),
        F.when(F.col("l_returnflag") != "R",
               F.struct(F.concat(F.lit("Flag "), F.col("l_returnflag")).alias("displayName")))
         .alias("team")))
    pages = nest_pages(li, ["l_suppkey"], row_hash(sk), sk, tx, page_size)
    return pages.select(
        F.lit("transactions").alias("resource"),
        F.col("l_suppkey").cast("string").alias("supplier"),
        "page",
        jobj(kv("count", jnum(F.col("n_items"))),
             kv("transactions", F.col("items"))).alias("body"))


def news_docs(spark: SparkSession, sf_dir: str, page_size: int = ARTICLES_PER_DOC) -> DataFrame:
    """News per source (from ``documents``): ``{header, articles:[{id,
    headline, description, categories:[{description: lang}]}]}``; the
    description is the whole text."""
    d = load_table(spark, sf_dir, "documents")
    art = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.col("source"), F.lit(" #"), F.col("doc_id").cast("string")).alias("headline"),
        F.col("text").alias("description"),
        F.array(F.struct(F.col("lang").alias("description"))).alias("categories")))
    pages = nest_pages(d, ["source"], F.col("doc_id"), F.col("doc_id"), art, page_size)
    return pages.select(
        F.lit("news").alias("resource"), "source", "page",
        jobj(kv("header", F.lit('"NBA News"')), kv("articles", F.col("items"))).alias("body"))
