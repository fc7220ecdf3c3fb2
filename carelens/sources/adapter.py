"""Claims adapter: derive the 15-column staging table from TPC-H-style tables.

The driver's test data holds ``lineitem``, ``orders``, ``customer``, ``part``,
``supplier`` and ``nation``; one claim is one line item.  The mapping is a
pure projection over a chain of inner equi-joins, so Catalyst prunes every
unused column at the parquet scan and picks the join strategy per side:

* lineitem ⋈ orders on the order key — both sides grow with the data, so this
  is a sort-merge join on the key (AQE splits skewed keys);
* customer, part and supplier also grow with the scale factor; we let the
  planner choose from their statistics (broadcast below
  ``spark.sql.autoBroadcastJoinThreshold``, shuffle otherwise);
* nation is a fixed 25-row table and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BLOOD_TYPES, CONDITIONS, EXPECTED_COLUMNS, MONEY, TYPED_COLUMNS

# Fixed values of the mapping (see FIXTURES.md §2).
MEDICATIONS = ["Aspirin", "Ibuprofen", "Lipitor", "Paracetamol", "Penicillin"]
PART_TYPE_TO_CONDITION = [
    ("ECONOMY", "Diabetes"), ("LARGE", "Asthma"), ("MEDIUM", "Obesity"),
    ("PROMO", "Arthritis"), ("SMALL", "Hypertension"),
]
OTHER_CONDITION = "Cancer"
PRIORITY_TO_ADMISSION = [("1-URGENT", "Urgent"), ("2-HIGH", "Emergency")]
OTHER_ADMISSION = "Elective"
RETURNFLAG_TO_RESULT = [("A", "Abnormal"), ("N", "Normal")]
OTHER_RESULT = "Inconclusive"
NATION_ROWS = 25  # TPC-H fixes the nation table at 25 rows


# Declared column types of the source tables (only the columns the adapter reads).
# With a declared schema the planner does not open file footers to infer one.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "part": "p_partkey bigint, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in TABLE_SCHEMAS:
        return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _lookup(col: Column, pairs, default: str) -> Column:
    expr = None
    for key, value in pairs:
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr.otherwise(default)


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # orders meet customers first: lineitem is then shuffled once, on the order key
    oc = od.join(cu, F.col("o_custkey") == F.col("c_custkey"))
    # parts come before the orders bring their names and dates, suppliers and nations after the
    # last shuffle and one by one, so the planner sees the size of each
    return (li.join(pa, F.col("l_partkey") == F.col("p_partkey"))
              .join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))


def _typed_columns() -> dict[str, Column]:
    admission = F.col("o_orderdate").cast("date")
    billing = (F.col("l_extendedprice").cast("decimal(12,2)")
               * F.col("l_quantity").cast("int")
               * F.lit(0.02).cast("decimal(2,2)")).cast(MONEY)
    return {
        "Name": F.col("c_name"),
        "Age": ((F.col("c_custkey") * 37) % 102).cast("int"),
        "Gender": F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female"),
        "BloodType": _pick(BLOOD_TYPES, F.floor(F.col("c_custkey") / 2) % 8),
        "MedicalCondition": _lookup(F.col("p_type"), PART_TYPE_TO_CONDITION, OTHER_CONDITION),
        "DateOfAdmission": admission,
        "Doctor": F.col("s_name"),
        "Hospital": F.col("n_name"),
        "InsuranceProvider": F.col("c_mktsegment"),
        "BillingAmount": billing,
        "RoomNumber": (F.lit(101) + F.col("l_suppkey") % 400).cast("int"),
        "AdmissionType": _lookup(F.col("o_orderpriority"), PRIORITY_TO_ADMISSION, OTHER_ADMISSION),
        "DischargeDate": F.date_add(
            admission, ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 40).cast("int")),
        "Medication": _pick(MEDICATIONS, F.col("l_partkey") % 5),
        "TestResults": _lookup(F.col("l_returnflag"), RETURNFLAG_TO_RESULT, OTHER_RESULT),
    }


def load_claims(spark: SparkSession, path: str) -> DataFrame:
    """Staging as written by ``write_staging`` (parquet), with the declared schema."""
    from ..schema import CLAIMS_SCHEMA
    return spark.read.schema(CLAIMS_SCHEMA).parquet(path)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging table (one row per line item), schema ``CLAIMS_SCHEMA``."""
    cols = _typed_columns()
    return _joined(spark, sf_dir).select(*[cols[c].alias(c) for c in TYPED_COLUMNS])


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped claims as a CSV would carry them, with deterministic faults.

    Columns are the 15 CSV header names (strings) plus ``claim_id``.
    """
    cols = _typed_columns()
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    s = {c: cols[t].cast("string") for c, t in zip(EXPECTED_COLUMNS, TYPED_COLUMNS)}
    s["Discharge Date"] = F.col("l_shipdate").cast("date").cast("string")
    s["Age"] = (F.when(ok % 97 == 0, "-1").when(ok % 97 == 1, "151")
                 .when(ok % 97 == 2, "abc").otherwise(s["Age"]))
    s["Gender"] = F.when(pk % 89 == 0, "Other").otherwise(s["Gender"])
    s["Blood Type"] = F.when(sk % 83 == 0, "X+").otherwise(s["Blood Type"])
    s["Billing Amount"] = (F.when(pk % 79 == 0, "free").when(pk % 79 == 1, "-100")
                            .otherwise(s["Billing Amount"]))
    s["Date of Admission"] = F.when(ok % 73 == 0, "01/15/2023").otherwise(s["Date of Admission"])
    s["Name"] = F.when(pk % 3 == 0, F.concat(F.lit("  "), s["Name"], F.lit("  "))).otherwise(s["Name"])
    claim_id = F.concat_ws("-", ok.cast("string"), F.col("l_linenumber").cast("string"))
    return _joined(spark, sf_dir).select(
        claim_id.alias("claim_id"), *[s[c].alias(c) for c in EXPECTED_COLUMNS])


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient profiles to look up, one per customer; some can match nothing: an age unknown, below 0
    or above 150, a condition that no claim has.

    Columns: profile_id, age, blood_type, condition, medication.
    """
    key = F.col("c_custkey")
    odd = key % 97
    return table(spark, sf_dir, "customer").select(
        key.alias("profile_id"),
        F.when(odd == 3, F.lit(None)).when(odd == 5, -5).when(odd == 7, 200)
         .otherwise((key * 53) % 151).cast("int").alias("age"),
        _pick(BLOOD_TYPES, F.floor(key / 3) % 8).alias("blood_type"),
        F.when(key % 89 == 11, "Gout").otherwise(_pick(CONDITIONS, F.floor(key / 7) % 6)).alias("condition"),
        _pick(MEDICATIONS, (key + F.floor(key / 40)) % 5).alias("medication"),
    )
