"""Adapters from the driver's TPC-H-like tables to the claims data model.

The mapping rules are the test-data contract (FIXTURES.md part B): lineitem
lines become claims, suppliers become providers, customers become
beneficiaries, and the region of the supplier is the provider specialty. The
oracle SQL in ``plans/oracle.py`` builds the very same rows in DuckDB.

The fixed-size dimension tables (nation: 25 rows, region: 5 rows) are
broadcast outright; the supplier → specialty map and the part lookup grow
with the data, so their joins, like lineitem ⋈ orders, carry no hint and are
left to Catalyst/AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import numbered
from ..schemas import (CHRONIC_CONDITIONS, DIAGNOSIS_PREFIX, HCPCS_PREFIX, N_DIAGNOSIS_COLS,
                       N_HCPCS_COLS, N_PROCEDURE_COLS, PROCEDURE_PREFIX)
from .tables import table

# --- fixed values: return flag -> claim type --------------------------------
RETURNFLAG_TO_TYPE = {"A": "inpatient", "N": "outpatient", "R": "carrier"}


def _claim_type(flag: Column) -> Column:
    expr = None
    for k, v in RETURNFLAG_TO_TYPE.items():
        expr = F.when(flag == k, v) if expr is None else expr.when(flag == k, v)
    return expr


def _cents(c: str) -> Column:
    """A 2-decimal double as exact integer hundredths."""
    return F.rint(F.col(c) * 100).cast("bigint")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part ⋈ orders ⋈ supplier ⋈ nation ⋈ region, pruned to what the claim
    model needs: cents and dates are worked out before the rows are moved. The orders
    come last of the large tables, so the lines of an order end in one partition."""
    # price × discount rounded half-up to cents, in exact integer arithmetic (both carry 2 decimals)
    amount = F.floor((_cents("l_extendedprice") * _cents("l_discount") + 50) / 100).cast("bigint")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", amount.alias("amount_cents"),
        _cents("l_discount").alias("discount_cents"), F.to_date("l_shipdate").alias("ship_date"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # the file's size tells Spark whether the suppliers are few; of a join it knows no size
    return (li.join(p, li.l_partkey == p.p_partkey)
              .join(o, li.l_orderkey == o.o_orderkey)
              .join(s, li.l_suppkey == s.s_suppkey)
              .join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
              .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))


def _amount() -> Column:
    return F.col("amount_cents") / 100.0


def _procedure_codes() -> Column:
    q = F.concat(F.lit("Q"), F.floor(F.col("l_quantity") / 10).cast("bigint").cast("string"))
    d = F.concat(F.lit("D"), F.col("discount_cents").cast("string"))
    return F.when(F.col("l_linenumber") == 1, F.array().cast("array<string>")).otherwise(F.array(q, d))


#: What a claim is made of.
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "r_name", "l_returnflag", "order_date",
                "ship_date", "p_brand", "p_type", "l_quantity", "discount_cents", "amount_cents"]


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that claims are made of, narrower than the claims."""
    return _lines(spark, sf_dir).select(*LINE_COLUMNS)


def claims_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized claims (schema ``schemas.CLAIMS_SCHEMA``) straight from the
    driver tables."""
    return claims_of_lines(claim_lines(spark, sf_dir))


def claims_of_lines(lines: DataFrame) -> DataFrame:
    """A claim of each line, beside the columns that are not of :data:`LINE_COLUMNS`."""
    start = F.col("order_date")
    end = F.col("ship_date")
    ctype = _claim_type(F.col("l_returnflag"))
    return lines.select(
        *[c for c in lines.columns if c not in LINE_COLUMNS],
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("claim_id"),
        F.concat(F.lit("BENE"), F.col("o_custkey").cast("string")).alias("beneficiary_id"),
        F.concat(F.lit("PRV"), F.col("l_suppkey").cast("string")).alias("provider_id"),
        F.col("r_name").alias("provider_specialty"),
        ctype.alias("claim_type"),
        start.alias("claim_start_date"),
        end.alias("claim_end_date"),
        F.year("order_date").cast("int").alias("claim_year"),
        F.col("p_brand").alias("admit_diagnosis_cd"),
        F.array(F.col("p_brand"), F.col("p_type")).alias("diagnosis_codes"),
        _procedure_codes().alias("procedure_codes"),
        _amount().alias("reimbursement_amt"),
        F.when(ctype == "inpatient", F.greatest(F.lit(0), F.datediff(end, start)))
         .otherwise(F.lit(0)).cast("int").alias("length_of_stay_days"),
    )


# ---------------------------------------------------------------------------
# Raw (all-text) claim files with dirt, as the CSV readers would see them.
# Dirt is keyed on data attributes so DuckDB can build the same rows.
# ---------------------------------------------------------------------------

def _yyyymmdd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def raw_claims_from_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One all-string DataFrame per claim file, with the raw column names.

    Dirt rules (by l_quantity / l_linenumber):
      quantity 13 → blank CLM_ID;  17 → whitespace PRVDR_NUM;  19 → blank DESYNPUF_ID
      quantity 29 → amount 'abc';  31 → blank amount
      quantity 37 → start date as YYYYMM;  41 → impossible start date (month 13)
      quantity 43 → inpatient _LOS with a fraction ('n.7');  linenumber 3 → blank _LOS
      carrier linenumber 2 → blank PRVDR_SPCLTY
    """
    lines = _lines(spark, sf_dir)
    q = F.col("l_quantity")
    ln = F.col("l_linenumber")
    start = F.col("order_date")
    end = F.col("ship_date")
    claim_id = F.concat_ws("-", *[F.col(c).cast("string") for c in
                                  ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    amount = _amount().cast("string")
    start_txt = (F.when(q == 37, F.date_format(start, "yyyyMM"))
                  .when(q == 41, F.concat(F.date_format(start, "yyyy"), F.lit("1345")))
                  .otherwise(_yyyymmdd(start)))
    los_days = F.greatest(F.lit(0), F.datediff(end, start))
    los_txt = (F.when(ln == 3, F.lit(None).cast("string"))
                .when(q == 43, F.concat(los_days.cast("string"), F.lit(".7")))
                .otherwise(los_days.cast("string")))
    pcodes = _procedure_codes()
    common = [
        F.when(q == 13, F.lit(None).cast("string")).otherwise(claim_id).alias("CLM_ID"),
        F.when(q == 19, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("BENE"), F.col("o_custkey").cast("string"))).alias("DESYNPUF_ID"),
        F.when(q == 17, F.lit("   "))
         .otherwise(F.concat(F.lit("PRV"), F.col("l_suppkey").cast("string"))).alias("PRVDR_NUM"),
        start_txt.alias("CLM_FROM_DT"),
        _yyyymmdd(end).alias("CLM_THRU_DT"),
    ]
    dx = [F.col("p_brand").alias(f"{DIAGNOSIS_PREFIX}1"), F.col("p_type").alias(f"{DIAGNOSIS_PREFIX}2")] + \
         [F.lit(None).cast("string").alias(c) for c in numbered(DIAGNOSIS_PREFIX, N_DIAGNOSIS_COLS)[2:]]
    amt_txt = (F.when(q == 29, F.lit("abc")).when(q == 31, F.lit(None).cast("string")).otherwise(amount))
    out = {}
    for flag, ctype in RETURNFLAG_TO_TYPE.items():
        part = lines.where(F.col("l_returnflag") == flag)
        if ctype == "carrier":
            proc = [F.get(pcodes, i).alias(f"{HCPCS_PREFIX}{i + 1}") for i in range(2)] + \
                   [F.lit(None).cast("string").alias(f"{HCPCS_PREFIX}{N_HCPCS_COLS}")]
            extra = [F.when(ln == 2, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("PRVDR_SPCLTY"),
                     amt_txt.alias("LINE_NCH_PMT_AMT")]
        else:
            proc = [F.get(pcodes, i).alias(f"{PROCEDURE_PREFIX}{i + 1}") for i in range(2)] + \
                   [F.lit(None).cast("string").alias(c) for c in numbered(PROCEDURE_PREFIX, N_PROCEDURE_COLS)[2:]]
            extra = [amt_txt.alias("CLM_PMT_AMT")]
        los = [los_txt.alias("_LOS")] if ctype == "inpatient" else [F.lit("4").alias("_LOS")]
        out[ctype] = part.select(*common, *dx, *proc, *extra, *los)
    return out


def raw_beneficiaries_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string beneficiary file from customer.

    Birth date: (1930 + custkey % 41) || '0101'; blank when the account balance
    is negative and the segment is MACHINERY (default year applies).
    Chronic flags by rule, in the fixed condition order:
      Diabetes: AUTOMOBILE, Hypertension: balance < 0, HeartFailure: BUILDING,
      IschemicHeart: FURNITURE, COPD: HOUSEHOLD, Depression: MACHINERY,
      Arthritis: balance > 5000, KidneyDisease: balance < 1000,
      Cancer: nationkey < 5, Stroke: nationkey > 20.
    """
    c = table(spark, sf_dir, "customer")
    seg, bal, nat = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("c_nationkey")
    rules = [seg == "AUTOMOBILE", bal < 0, seg == "BUILDING", seg == "FURNITURE", seg == "HOUSEHOLD",
             seg == "MACHINERY", bal > 5000, bal < 1000, nat < 5, nat > 20]
    flags = [F.when(r, F.lit("1")).otherwise(F.lit("0")).alias(f"SP_{name}")
             for name, r in zip(CHRONIC_CONDITIONS, rules)]
    birth = F.concat((F.lit(1930) + F.col("c_custkey") % 41).cast("string"), F.lit("0101"))
    return c.select(
        F.concat(F.lit("BENE"), F.col("c_custkey").cast("string")).alias("DESYNPUF_ID"),
        F.when((bal < 0) & (seg == "MACHINERY"), F.lit(None).cast("string")).otherwise(birth).alias("BENE_BIRTH_DT"),
        nat.cast("string").alias("BENE_STATE_CD"),
        *flags,
    )


def flag_messages_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag-event JSON messages (column ``value``) from the events table.

    claim_id = event_id, provider_id = user_id, score = least(1, value/200),
    driver_features = [event_type], flag_date = date(ts), timestamp = ts.
    Dirt by attribute: event_type 'error' with value < 5 → not JSON;
    'signup' with value < 5 → empty claim_id; 'view' with value < 5 → bad flag_date.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ts = F.col("ts").cast("timestamp")
    low = F.col("value") < 5
    claim_id = F.when((F.col("event_type") == "signup") & low, F.lit("")).otherwise(F.col("event_id").cast("string"))
    flag_date = F.when((F.col("event_type") == "view") & low, F.lit("not-a-date")) \
                 .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    msg = F.to_json(F.struct(
        claim_id.alias("claim_id"),
        F.col("user_id").cast("string").alias("provider_id"),
        F.least(F.lit(1.0), F.col("value") / 200).alias("score"),
        F.array(F.col("event_type")).alias("driver_features"),
        flag_date.alias("flag_date"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    ))
    bad = (F.col("event_type") == "error") & low
    return e.select(F.col("event_id"), ts.alias("ts"),
                    F.when(bad, F.concat(F.lit("{broken "), F.col("event_id").cast("string")))
                     .otherwise(msg).alias("value"))


# ---------------------------------------------------------------------------
# Planted repeats: what deduplication must take out again.
# ---------------------------------------------------------------------------

def _versions(df: DataFrame, key: Column, every: int) -> DataFrame:
    """``df`` with ``_old``: 0 for each row, and 1 for an older version of every
    ``every``-th."""
    return df.withColumn("_old", F.explode(F.when(key % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def _order_key() -> Column:
    return F.split("claim_id", "-")[0].cast("long")


def with_stale_claims(claims: DataFrame) -> DataFrame:
    """Claims, and of those with an order key divisible by 29 an older version: a
    day earlier, with 100 more of amount and another beneficiary (loses by D18)."""
    return _as_of_version(_versions(claims, _order_key(), 29))


def _as_of_version(v: DataFrame) -> DataFrame:
    old = F.col("_old") == 1
    return v.select(*[(F.when(old, F.date_sub(c, 1)).otherwise(F.col(c)) if c == "claim_start_date" else
                       F.when(old, F.col(c) + 100).otherwise(F.col(c)) if c == "reimbursement_amt" else
                       F.when(old, F.lit("BENE-stale")).otherwise(F.col(c)) if c == "beneficiary_id" else F.col(c)).alias(c) for c in v.columns if c != "_old"])


def stale_lines(lines: DataFrame) -> DataFrame:
    """The lines of :func:`with_stale_claims`, to be made claims by :func:`claims_of_versions`."""
    return _versions(lines, F.col("l_orderkey"), 29)


def claims_of_versions(lines: DataFrame) -> DataFrame:
    return _as_of_version(claims_of_lines(lines))


def with_rewrites(labeled: DataFrame) -> DataFrame:
    """Labeled claims, and of those with an order key divisible by 31 a version of
    the same key that loses: less amount, the other label."""
    v, old = _versions(labeled, _order_key(), 31), F.col("_old") == 1
    return v.select(*[(F.when(old, F.col(c) - 1).otherwise(F.col(c)) if c == "reimbursement_amt" else
                       F.when(old, 1 - F.col(c)).otherwise(F.col(c)) if c == "label" else F.col(c)).alias(c) for c in labeled.columns])


def with_resent(messages: DataFrame) -> DataFrame:
    """Flag messages, and of those with an event id divisible by 7 an older message
    with the same key but another provider (loses by its timestamp)."""
    v, old = _versions(messages, F.col("event_id"), 7), F.col("_old") == 1
    stale = F.regexp_replace(F.regexp_replace("value", '"provider_id":"', '"provider_id":"stale-'), '"timestamp":"....', '"timestamp":"1900')
    return v.withColumn("value", F.when(old, stale).otherwise(F.col("value"))).drop("_old")


def broken_line(line: Column, claim_id: Column) -> Column:
    """A CSV line broken by its claim's order key: 7 of 50 lose cells, 13 of 50 get
    one more, 29 of 50 start with an open quote."""
    k = F.split(claim_id, "-")[0].cast("long") % 50
    return (F.when(k == 7, F.array_join(F.slice(F.split(line, ","), 1, 3), ","))
             .when(k == 13, F.concat(line, F.lit(",more"))).when(k == 29, F.concat(F.lit('"'), line)).otherwise(line))
