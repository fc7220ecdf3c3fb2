"""Shared SQL text: the claims CTE (same mapping as carelens.sources.adapter) and
exact-rounding macros that reproduce Spark's decimal arithmetic in DuckDB."""

CLAIMS = """
claims AS (
  SELECT
    c.c_name AS Name,
    CAST((c.c_custkey * 37) % 102 AS INTEGER) AS Age,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
    (['A+','A-','B+','B-','AB+','AB-','O+','O-'])[CAST(floor(c.c_custkey / 2) % 8 AS INTEGER) + 1] AS BloodType,
    CASE p.p_type WHEN 'ECONOMY' THEN 'Diabetes' WHEN 'LARGE' THEN 'Asthma' WHEN 'MEDIUM' THEN 'Obesity'
      WHEN 'PROMO' THEN 'Arthritis' WHEN 'SMALL' THEN 'Hypertension' ELSE 'Cancer' END AS MedicalCondition,
    CAST(o.o_orderdate AS DATE) AS DateOfAdmission,
    s.s_name AS Doctor,
    n.n_name AS Hospital,
    c.c_mktsegment AS InsuranceProvider,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS INTEGER)
         * CAST(0.02 AS DECIMAL(2,2)) AS DECIMAL(18,4)) AS BillingAmount,
    CAST(101 + l.l_suppkey % 400 AS INTEGER) AS RoomNumber,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Emergency'
      ELSE 'Elective' END AS AdmissionType,
    CAST(CAST(o.o_orderdate AS DATE) + CAST((l.l_partkey * 7 + l.l_linenumber) % 40 AS INTEGER) AS DATE) AS DischargeDate,
    (['Aspirin','Ibuprofen','Lipitor','Paracetamol','Penicillin'])[CAST(l.l_partkey % 5 AS INTEGER) + 1] AS Medication,
    CASE l.l_returnflag WHEN 'A' THEN 'Abnormal' WHEN 'N' THEN 'Normal' ELSE 'Inconclusive' END AS TestResults,
    l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

AGE_GROUP = """CASE
        WHEN {a} BETWEEN 0 AND 1 THEN '0-1' WHEN {a} BETWEEN 2 AND 5 THEN '2-5'
        WHEN {a} BETWEEN 6 AND 12 THEN '6-12' WHEN {a} BETWEEN 13 AND 18 THEN '13-18'
        WHEN {a} BETWEEN 19 AND 30 THEN '19-30' WHEN {a} BETWEEN 31 AND 45 THEN '31-45'
        WHEN {a} BETWEEN 46 AND 60 THEN '46-60' WHEN {a} BETWEEN 61 AND 80 THEN '61-80'
        WHEN {a} >= 81 THEN '81+' ELSE 'Unknown' END"""

VIEW = """
v AS (
  SELECT Age, Gender, BloodType, MedicalCondition, DateOfAdmission, Hospital, InsuranceProvider,
         BillingAmount, RoomNumber, AdmissionType, DischargeDate, Medication, TestResults,
         CAST(datediff('day', DateOfAdmission, DischargeDate) AS INTEGER) AS LengthOfStay,
         """ + AGE_GROUP.format(a="Age") + """ AS AgeGroup
  FROM claims
)"""


def with_claims(*ctes: str, view: bool = True) -> str:
    parts = [CLAIMS] + ([VIEW] if view else []) + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


def _half_up(num: str, den: str) -> str:
    """round(num/den) half away from zero, integers (den > 0)."""
    return f"(SIGN({num}) * ((2 * ABS({num}) + ({den})) // (2 * ({den}))))"


def avg2(col: str = "BillingAmount") -> str:
    """Spark: round(avg(decimal(18,4)) [decimal(22,8)], 2) → double."""
    s = f"CAST(SUM({col}) * 10000 AS HUGEINT)"
    n = f"COUNT({col})"
    a8 = _half_up(f"({s} * 10000)", n)
    return f"(CAST({_half_up(a8, '1000000')} AS DOUBLE) / 100)"


def avg1_int(col: str) -> str:
    """Spark: round(avg(decimal(20,0)) [decimal(24,4)], 1) → double."""
    s = f"CAST(SUM({col}) AS HUGEINT)"
    n = f"COUNT({col})"
    a4 = _half_up(f"({s} * 10000)", n)
    return f"(CAST({_half_up(a4, '1000')} AS DOUBLE) / 10)"


def money2(expr: str) -> str:
    """Spark: round(decimal, 2) → double (exact half-up on the decimal)."""
    s = f"CAST(({expr}) * 10000 AS HUGEINT)"
    return f"(CAST({_half_up(s, '100')} AS DOUBLE) / 100)"


def cpd_avg2(b: str = "BillingAmount", los: str = "LengthOfStay") -> str:
    """Spark: round(avg(b / los) for los > 0, 2) with b decimal(18,4), los int.

    b / los is decimal(29,15) (half-up), its average decimal(33,19), then round 2.
    """
    v15 = _half_up(f"(CAST({b} * 10000 AS HUGEINT) * CAST(100000000000 AS HUGEINT))", los)
    s = f"SUM(CASE WHEN {los} > 0 THEN {v15} END)"
    n = f"COUNT(CASE WHEN {los} > 0 THEN 1 END)"
    a19 = _half_up(f"({s} * 10000)", n)
    return f"(CAST({_half_up(a19, 'CAST(100000000000000000 AS HUGEINT)')} AS DOUBLE) / 100)"


def avg8(col: str) -> str:
    """Spark's decimal(22,8) average of a decimal(18,4) column, as an integer in 1e-8 units."""
    s = f"CAST(SUM({col}) * 10000 AS HUGEINT)"
    return _half_up(f"({s} * 10000)", f"COUNT({col})")


def cents_of8(a8: str) -> str:
    """Round an integer in 1e-8 units to cents (integer)."""
    return _half_up(a8, "1000000")


def cpd_raw(b: str = "BillingAmount", los: str = "LengthOfStay") -> str:
    """Unrounded Spark average of b / los (los > 0) as an integer in 1e-19 units."""
    v15 = _half_up(f"(CAST({b} * 10000 AS HUGEINT) * CAST(100000000000 AS HUGEINT))", los)
    s = f"SUM(CASE WHEN {los} > 0 THEN {v15} END)"
    n = f"COUNT(CASE WHEN {los} > 0 THEN 1 END)"
    return _half_up(f"({s} * 10000)", n)


def pct1(num: str, den: str) -> str:
    """round(100 * num / den, 1) exactly, for integers."""
    return f"(CAST({_half_up(f'(CAST({num} AS HUGEINT) * 1000)', den)} AS DOUBLE) / 10)"
