"""The feature plan and the rules, on test tables put into the form of the raw tables.

Customers stand for enterprises, every fourth on the test side. Orders are the
base table and most topic tables, events the branches and job offers.
"""

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.plans import features, scoring
from riskloom.sources.contracts import CONTRACTS
from riskloom.sources.tables import ORDER

YES, NO = "是", "否"
OUTSIDE = "浙江省"


def as_contract(name, rows, customer, row, given, rank=None):
    """``rows`` with the columns of a raw table: those ``given``, null for the others."""
    contract = CONTRACTS[name]
    rank = F.lit(0) if rank is None else rank
    order = {ORDER[0]: rank, ORDER[1]: F.lit("file"), ORDER[2]: F.lit(0), ORDER[3]: row}
    own = {c: given.get(c, F.lit(None)).cast("double" if c in contract.numbers else "string")
           for c in contract.names.values() if c != "qymc"}
    split = F.when(customer % 4 == 0, "test").otherwise("train")
    every = {"split": split, "qymc": customer.cast("string"), "is_chusai": 1 - rank, **order, **own}
    return rows.select(*[value.alias(c) for c, value in every.items()])


def raw_tables(spark, sf_dir):
    """All raw tables, from orders, events and customers."""
    orders, events, customers = (table(spark, sf_dir, t) for t in ("orders", "events", "customer"))
    number, status, priority, price = (F.col(f"o_{c}") for c in ("orderkey", "orderstatus", "orderpriority", "totalprice"))
    moment = F.col("o_orderdate").cast("string")
    day = F.substring(moment, 1, 10)
    slashed = lambda c: F.concat_ws("/", F.year(c), F.month(c), F.dayofmonth(c))

    def from_orders(name, rows, rank=None, **given):
        return as_contract(name, rows, F.col("o_custkey"), number, given, rank)

    def from_events(name, **given):
        return as_contract(name, events, F.col("user_id"), F.col("event_id"), given)

    train = orders.filter("o_custkey % 4 <> 0")
    return {
        "base": from_orders(
            "base", orders, F.when(status == "F", 0).otherwise(1), zch=number, tyshxydm=number % 1000, zczj=price,
            zczbbzmc=status, qyjglxmc=priority, hymldm=status, clrq=moment,
            hzrq=F.date_add(F.col("o_orderdate").cast("date"), (number % 400 - 100).cast("int")),
            zsszdsf=F.when(F.col("o_custkey") % 3 == 0, OUTSIDE).otherwise(scoring.PROVINCE),
            fddbrbz=F.when(status == "F", YES).otherwise(NO), sxdbbz=F.when(priority == "1-URGENT", YES), zw=priority,
            tzr=F.when(number % 5 > 0, number % 5), czbl=number % 100 / 4),
        "dishonest": from_orders("dishonest", train.filter("o_totalprice > 450000")),
        "punished": from_orders("punished", train.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")),
        "branch": from_events(
            "branch", fzqymc=F.col("event_type"), fzjgsf=F.col("value"), fzclsj=slashed("ts"),
            fzswsj=F.when(F.col("event_type") == "error", slashed(F.date_add("ts", 40))).otherwise("soon")),
        "registration": as_contract("registration", customers, F.col("c_custkey"), F.col("c_custkey"), {
            "jyfw": F.col("c_mktsegment"), "jgdzzs": F.col("c_name"), "sshymc": F.col("c_mktsegment"),
            "xzgh": F.concat(F.lit("32"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0")), "qyjd": F.col("c_acctbal")}),
        "revocation": from_orders("revocation", orders.filter("o_orderkey % 40 = 0")),
        "honour": from_orders("honour", orders.filter("o_orderstatus = 'F'")),
        "abnormal": from_orders("abnormal", orders.filter("o_orderpriority = '2-HIGH'"),
                                rwbh=number, zcdz=status, xxtgbmmc=priority, yynx=price),
        "tax": from_orders("tax", orders, shdw=priority, qy=status),
        "infringement": from_orders("infringement", orders.filter("o_totalprice < 50000")),
        "licence": from_orders("licence", orders.filter("o_orderkey % 3 = 0"), xkjzq=F.when(number % 5 > 0, day),
                               xkjdrq=moment, xknr=priority, dfbm=price),
        "inspection": from_orders("inspection", orders.filter("o_orderkey % 3 = 1"), njrq=slashed("o_orderdate"),
                                  njnd=F.year("o_orderdate"), njjgmc=priority),
        "recruitment": from_events(
            "recruitment", zylb=F.col("event_type"), zprq=F.col("ts").cast("date"),
            zprs=F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("招"), F.floor("value").cast("string"), F.lit("-9人")))
            .otherwise("若干")),
        "qualification": from_orders("qualification", orders.filter("o_orderkey % 3 = 2"), zzmc=status,
                                     zzsxq=F.replace(day, F.lit("-"), F.lit("")),
                                     zzjzq=F.date_add(F.col("o_orderdate").cast("date"), (number % 700).cast("int"))),
    }


SIDES = """
o AS (SELECT CASE WHEN o_custkey % 4 = 0 THEN 'test' ELSE 'train' END AS split, CAST(o_custkey AS VARCHAR) AS qymc, *,
        CAST(o_orderdate AS DATE) AS day FROM orders),
e AS (SELECT CASE WHEN user_id % 4 = 0 THEN 'test' ELSE 'train' END AS split, CAST(user_id AS VARCHAR) AS qymc, *,
        CAST(ts AS DATE) AS day FROM events),
spine AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY split, qymc ORDER BY o_orderstatus = 'F' DESC, o_orderkey) = 1)"""


@query(f"""
WITH {SIDES},
base AS (SELECT split, qymc, count(*) AS QYJL_number, count(DISTINCT nullif(o_orderkey % 5, 0)) + max(CAST(o_orderkey % 5 = 0 AS INT)) AS QY_tzrgs,
           count(DISTINCT o_orderpriority) AS QY_zwzls, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS QY_fddbrbz_gs,
           nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0) AS QY_sxdbbz_gs, max(o_orderkey % 100 / 4) AS czbl_max,
           min(o_orderkey % 100 / 4) AS czbl_min, avg(o_orderkey % 100 / 4) AS czbl_mean, stddev_samp(o_orderkey % 100 / 4) AS czbl_std,
           count(*) FILTER (o_orderkey % 40 = 0) AS FRXZXKZX_number, count(*) FILTER (o_orderstatus = 'F') AS QYBZRYXX_number,
           count(*) FILTER (o_orderpriority = '2-HIGH') AS QYFZCHRD_number, count(*) FILTER (o_totalprice < 50000) AS SDBDJQQJMCF_number,
           count(*) FILTER (o_orderkey % 3 = 0) AS SGSFRXZXKXX_number,
           max(CAST(split = 'train' AND o_totalprice > 450000 AS INT)) AS is_shixin,
           max(CAST(split = 'train' AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AS INT)) AS is_chufa
         FROM o GROUP BY ALL),
jobs AS (SELECT split, qymc, count(*) AS ZPSJ_number, count(DISTINCT event_type) AS ZPSJ_zylb_kinds, count(DISTINCT day) AS ZPSJ_zprq_kinds,
           count(DISTINCT CASE WHEN event_id % 3 > 0 THEN floor(value) ELSE -1 END) AS ZPSJ_zprs_kinds,
           max(CAST(floor(value) AS BIGINT)) FILTER (event_id % 3 > 0) AS ZPSJ_zprs_max,
           avg(CAST(floor(value) AS BIGINT)) FILTER (event_id % 3 > 0) AS ZPSJ_zprs_mean
         FROM e GROUP BY ALL),
branch AS (SELECT split, qymc, event_type, value, CAST(day AS TIMESTAMP) AS born,
             CASE WHEN event_type = 'error' THEN CAST(day + 40 AS TIMESTAMP) END AS died
           FROM e QUALIFY row_number() OVER (PARTITION BY split, qymc ORDER BY event_id) = 1),
abnormal AS (SELECT split, qymc, o_orderkey, o_orderstatus, o_totalprice FROM o WHERE o_orderpriority = '2-HIGH'
             QUALIFY row_number() OVER (PARTITION BY split, qymc ORDER BY o_orderkey) = 1),
licence AS (SELECT split, qymc, o_orderpriority, o_totalprice, o_orderdate AS decided,
              CASE WHEN o_orderkey % 5 > 0 THEN CAST(day AS TIMESTAMP) END AS ends
            FROM o WHERE o_orderkey % 3 = 0
            QUALIFY row_number() OVER (PARTITION BY split, qymc
              ORDER BY CASE WHEN o_orderkey % 5 > 0 THEN CAST(day AS VARCHAR) END DESC NULLS LAST, o_orderkey) = 1),
inspection AS (SELECT split, qymc, CAST(day AS TIMESTAMP) AS inspected, o_orderpriority
               FROM o WHERE o_orderkey % 3 = 1
               QUALIFY row_number() OVER (PARTITION BY split, qymc
                 ORDER BY year(day) || '/' || month(day) || '/' || day(day) DESC, o_orderkey) = 1),
qualification AS (SELECT split, qymc, o_orderstatus, CAST(day AS TIMESTAMP) AS starts, CAST(day + CAST(o_orderkey % 700 AS INT) AS TIMESTAMP) AS ends
                  FROM o WHERE o_orderkey % 3 = 2
                  QUALIFY row_number() OVER (PARTITION BY split, qymc
                    ORDER BY CAST(day + CAST(o_orderkey % 700 AS INT) AS VARCHAR) DESC, o_orderkey) = 1),
wide AS (
  SELECT s.split, s.qymc, CAST(s.o_orderkey AS VARCHAR) AS zch, s.o_totalprice AS zczj, s.o_orderstatus AS hymldm,
    CAST(s.o_orderstatus = 'F' AS INT) AS is_chusai, CAST(s.day AS TIMESTAMP) AS clrq,
    CAST(s.day + CAST(s.o_orderkey % 400 - 100 AS INT) AS TIMESTAMP) AS hzrq, base.* EXCLUDE (split, qymc),
    CASE WHEN o_custkey % 3 = 0 THEN '{OUTSIDE}' ELSE '{scoring.PROVINCE}' END AS zsszdsf,
    coalesce(ZPSJ_number, 0) AS ZPSJ_number, ZPSJ_zylb_kinds, ZPSJ_zprq_kinds, ZPSJ_zprs_kinds, ZPSJ_zprs_max, ZPSJ_zprs_mean,
    CAST(branch.qymc IS NOT NULL AS INT) AS has_branch, branch.event_type AS fzqymc, branch.value AS fzjgsf, born AS fzclsj, died AS fzswsj,
    CAST(died IS NOT NULL AS INT) AS is_FZ_die, CAST(c_custkey IS NOT NULL AS INT) AS has_registration, c_mktsegment AS jyfw,
    c_acctbal AS qyjd, substr(c_name, 1, 3) AS jgdzzs_top3, substr(c_name, 1, 6) AS jgdzzs_top6,
    '32' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS xzgh_full,
    CAST(abnormal.o_orderkey AS VARCHAR) AS QYFZCHRD_rwbh, abnormal.o_orderstatus AS QYFZCHRD_zcdz, abnormal.o_totalprice AS QYFZCHRD_yynx,
    licence.o_orderpriority AS SGSFRXZXKXX_xknr, licence.o_totalprice AS SGSFRXZXKXX_dfbm, licence.ends AS SGSFRXZXKXX_xkjzq,
    decided AS SGSFRXZXKXX_xkjdrq, inspected AS XKZZNJXX_njrq, inspection.o_orderpriority AS XKZZNJXX_njjgmc,
    qualification.o_orderstatus AS ZZDJBGXX_zzmc, starts AS ZZDJBGXX_zzsxq, qualification.ends AS ZZDJBGXX_zzjzq
  FROM spine s JOIN base USING (split, qymc) LEFT JOIN jobs USING (split, qymc) LEFT JOIN branch USING (split, qymc)
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN abnormal USING (split, qymc) LEFT JOIN licence USING (split, qymc)
    LEFT JOIN inspection USING (split, qymc) LEFT JOIN qualification USING (split, qymc))
SELECT * REPLACE (round(czbl_std, 6) AS czbl_std, round(ZPSJ_zprs_mean, 6) AS ZPSJ_zprs_mean),
  CAST(year(clrq) AS INT) AS clrq_year, CAST(month(hzrq) AS INT) AS hzrq_month, CAST(day(XKZZNJXX_njrq) AS INT) AS XKZZNJXX_njrq_day,
  date_diff('day', clrq, hzrq) AS clhz_deltaDay, date_diff('day', fzclsj, fzswsj) AS fzsw_deltaDay,
  date_diff('day', SGSFRXZXKXX_xkjdrq, SGSFRXZXKXX_xkjzq) AS SGSFRXZXKXX_xkjdjz_deltaDay,
  date_diff('day', hzrq, XKZZNJXX_njrq) AS njhz_deltaDay, date_diff('day', ZZDJBGXX_zzsxq, ZZDJBGXX_zzjzq) AS ZZDJBGXX_jzsx_deltaDay,
  date_diff('day', clrq, ZZDJBGXX_zzjzq) AS zzjzcl_deltaDay,
  CASE WHEN hymldm IS NOT NULL THEN dense_rank() OVER (ORDER BY hymldm NULLS LAST) - 1 END AS hymldm_encoder,
  CASE WHEN jyfw IS NOT NULL THEN dense_rank() OVER (ORDER BY jyfw NULLS LAST) - 1 END AS jyfw_encoder,
  CASE WHEN QYFZCHRD_rwbh IS NOT NULL THEN dense_rank() OVER (ORDER BY QYFZCHRD_rwbh NULLS LAST) - 1 END AS QYFZCHRD_rwbh_encoder,
  CASE WHEN ZZDJBGXX_zzmc IS NOT NULL THEN dense_rank() OVER (ORDER BY ZZDJBGXX_zzmc NULLS LAST) - 1 END AS ZZDJBGXX_zzmc_encoder
FROM wide
""")
def feature_plan(spark, sf_dir):
    """The wide row of every enterprise: spine, labels, counts, statistics, picks, dates, gaps, codes."""
    built = features.build_features(raw_tables(spark, sf_dir))
    counts = ["QYJL_number", "FRXZXKZX_number", "QYBZRYXX_number", "QYFZCHRD_number", "SDBDJQQJMCF_number",
              "SGSFRXZXKXX_number", "ZPSJ_number"]
    people = ["QY_tzrgs", "QY_zwzls", "QY_fddbrbz_gs", "QY_sxdbbz_gs"]
    numbers = ["czbl_max", "czbl_min", "czbl_mean", "ZPSJ_zylb_kinds", "ZPSJ_zprq_kinds", "ZPSJ_zprs_kinds", "ZPSJ_zprs_max"]
    branch = ["has_branch", "has_registration", "is_FZ_die", "fzqymc", "fzjgsf", "fzclsj", "fzswsj"]
    place = ["jyfw", "qyjd", "jgdzzs_top3", "jgdzzs_top6", "xzgh_full"]
    picked = ["QYFZCHRD_rwbh", "QYFZCHRD_zcdz", "QYFZCHRD_yynx", "SGSFRXZXKXX_xknr", "SGSFRXZXKXX_dfbm", "XKZZNJXX_njjgmc",
              "ZZDJBGXX_zzmc", *features.TOPIC_DATES]
    dates = ["clrq", "hzrq", "clrq_year", "hzrq_month", "XKZZNJXX_njrq_day", "clhz_deltaDay", "fzsw_deltaDay",
             "SGSFRXZXKXX_xkjdjz_deltaDay", "njhz_deltaDay", "ZZDJBGXX_jzsx_deltaDay", "zzjzcl_deltaDay"]
    codes = ["hymldm_encoder", "jyfw_encoder", "QYFZCHRD_rwbh_encoder", "ZZDJBGXX_zzmc_encoder"]
    return built.select(
        *features.KEY, "zch", "zczj", "hymldm", "is_chusai", "zsszdsf", "is_shixin", "is_chufa", *counts, *people, *numbers,
        F.round("czbl_std", 6).alias("czbl_std"), F.round("ZPSJ_zprs_mean", 6).alias("ZPSJ_zprs_mean"),
        *branch, *place, *picked, *dates, *codes)


@query(f"""
WITH {SIDES},
flags AS (SELECT qymc, count(DISTINCT o_orderkey % 1000) AS codes, count(DISTINCT o_orderkey) AS numbers,
            max(CAST(o_orderkey % 40 = 0 AS INT)) AS is_fr, max(CAST(o_orderpriority = '2-HIGH' AS INT)) AS is_fzc,
            max(CAST(o_totalprice < 50000 AS INT)) AS is_qq
          FROM o WHERE split = 'test' GROUP BY 1)
SELECT qymc, o_orderkey % 100 / 100 AS FORTARGET2,
  round(CASE WHEN o_custkey % 3 = 0 OR is_fr = 1 THEN 0 ELSE o_orderkey % 100 / 100
    / CASE WHEN is_fzc = 1 THEN 1.5 ELSE 1 END / CASE WHEN is_qq = 1 THEN 2 ELSE 1 END END, 9) AS FORTARGET1
FROM spine JOIN flags USING (qymc) WHERE split = 'test'
""")
def rule_plan(spark, sf_dir):
    """Rule flags from the test side's tables, applied to the scores. All branches belong to the first round."""
    tables = raw_tables(spark, sf_dir)
    spine = features.build_spine(tables["base"])
    score = F.col("zch").cast("long") % 100 / 100
    scores = spine.filter("split = 'test'").select("qymc", score.alias("FORTARGET1"), score.alias("FORTARGET2"))
    adjusted = scoring.apply_rules(scores, scoring.rule_flags(tables, spine))
    return adjusted.select("qymc", F.round("FORTARGET1", 9).alias("FORTARGET1"), "FORTARGET2")


@query(f"""
WITH {SIDES},
labels AS (SELECT qymc, max(CAST(o_totalprice > 450000 AS INT)) AS a, max(CAST(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AS INT)) AS b
           FROM o WHERE split = 'train' GROUP BY 1),
scores AS (SELECT a, b, o_orderkey % 100 / 100 AS x, o_orderkey % 7 / 7 AS y FROM spine JOIN labels USING (qymc) WHERE split = 'train'),
first AS (SELECT x, sum(a) AS p, sum(1 - a) AS n, coalesce(sum(sum(1 - a)) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM scores GROUP BY x),
second AS (SELECT y, sum(b) AS p, sum(1 - b) AS n, coalesce(sum(sum(1 - b)) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
           FROM scores GROUP BY y),
pair AS (SELECT (SELECT sum(p * (below + n / 2)) / (sum(p) * sum(n)) FROM first) AS auc1,
                (SELECT sum(p * (below + n / 2)) / (sum(p) * sum(n)) FROM second) AS auc2)
SELECT round(auc1, 9) AS auc1, round(auc2, 9) AS auc2, round((auc1 + auc2) / 2, 9) AS mean_auc FROM pair
""")
def evaluation_plan(spark, sf_dir):
    """The task's metric of two scores of the train side."""
    tables = raw_tables(spark, sf_dir)
    labelled = features.label(features.build_spine(tables["base"]), tables["dishonest"], tables["punished"]).filter("split = 'train'")
    number = F.col("zch").cast("long")
    scores = labelled.select("qymc", (number % 100 / 100).alias("FORTARGET1"), (number % 7 / 7).alias("FORTARGET2"))
    found = scoring.evaluate(scores, labelled)
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])
