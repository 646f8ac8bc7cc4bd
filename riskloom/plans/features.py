"""The feature table: one wide row per enterprise and split.

Train and test rows live in one frame. Every grouping and join uses
``(split, qymc)``, so the two sides never mix; only the category codes and the
word vectors look at both.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.dates import date_parts, day_gap, parse_day, parse_slash_date, parse_timestamp
from riskloom.functions.text import first_int, prefix, region_code_parts
from riskloom.functions.values import YES, not_null_flag
from riskloom.operators.aggregates import Feature, entity_features, fills, summary
from riskloom.operators.encode import ordinal_encode
from riskloom.operators.joins import attach, membership_flags
from riskloom.operators.records import first_record, latest_record
from riskloom.operators.terms import VECTOR_SIZE, WordVectors, document_vectors, fit_word_vectors
from riskloom.session import stage
from riskloom.sources.tables import ORDER

KEY = ("split", "qymc")

# Prefix of each topic table's feature names.
TOPICS = {
    "revocation": "FRXZXKZX", "honour": "QYBZRYXX", "abnormal": "QYFZCHRD", "tax": "QYSWDJXX",
    "infringement": "SDBDJQQJMCF", "licence": "SGSFRXZXKXX", "inspection": "XKZZNJXX", "recruitment": "ZPSJ",
    "qualification": "ZZDJBGXX",
}

# Columns of the spine, taken from the first base record.
SPINE = ("zch", "tyshxydm", "zczj", "zczbbzmc", "qyjglxmc", "hymldm", "clrq", "hzrq", "zsszdsf", "is_chusai")


@dataclass(frozen=True)
class Pick:
    """One record per enterprise, taken from a topic table: the first, or the latest by a date column."""

    table: str
    columns: tuple[str, ...]
    by: str | None = None


# The picked columns of the topic tables and the date that decides which record is latest.
PICKS = (
    Pick("abnormal", ("rwbh", "zcdz", "xxtgbmmc", "swglm", "gljg", "djzclx", "yynx")),
    Pick("tax", ("fddbrzjmc", "shdw", "qy", "shjg", "djzclx")),
    Pick("licence", ("xzxkbm", "xkjdswh", "xxtgbmmc", "xknr", "xmmc", "splb", "dfbm", "xkjg", "xkjzq", "xkjdrq",
                     "xysyfw", "sjzt2"), by="xkjzq"),
    Pick("inspection", ("xxtgbmmc", "njrq", "njnd", "njjgmc", "njsxmc"), by="njrq"),
    Pick("qualification", ("zzmc", "zyfw", "zzsxq", "zzjzq", "rdjgqc", "zzzsbh"), by="zzjzq"),
)

# Parsed dates and the day gaps taken between them, as (name, from, to).
TOPIC_DATES = ("SGSFRXZXKXX_xkjzq", "SGSFRXZXKXX_xkjdrq", "XKZZNJXX_njrq", "ZZDJBGXX_zzsxq", "ZZDJBGXX_zzjzq")
GAPS = (
    ("clhz_deltaDay", "clrq", "hzrq"),
    ("fzsw_deltaDay", "fzclsj", "fzswsj"),
    ("SGSFRXZXKXX_xkjdjz_deltaDay", "SGSFRXZXKXX_xkjdrq", "SGSFRXZXKXX_xkjzq"),
    ("clxkjz_deltaDay", "clrq", "SGSFRXZXKXX_xkjzq"),
    ("hzxkjz_deltaDay", "hzrq", "SGSFRXZXKXX_xkjzq"),
    ("clxkjd_deltaDay", "clrq", "SGSFRXZXKXX_xkjdrq"),
    ("hzxkjd_deltaDay", "hzrq", "SGSFRXZXKXX_xkjdrq"),
    ("njhz_deltaDay", "hzrq", "XKZZNJXX_njrq"),
    ("njcl_deltaDay", "clrq", "XKZZNJXX_njrq"),
    ("ZZDJBGXX_jzsx_deltaDay", "ZZDJBGXX_zzsxq", "ZZDJBGXX_zzjzq"),
    ("zzsxcl_deltaDay", "clrq", "ZZDJBGXX_zzsxq"),
    ("zzjzcl_deltaDay", "clrq", "ZZDJBGXX_zzjzq"),
    ("zzsxhz_deltaDay", "hzrq", "ZZDJBGXX_zzsxq"),
    ("zzjzhz_deltaDay", "hzrq", "ZZDJBGXX_zzjzq"),
)

# Columns that get an ordinal code, by the table they come from.
ENCODED = {
    "": ("sshydm", "tyshxydm", "zczbbzmc", "hymldm", "zsszdsf", "fzhyml", "xxtgbmmc", "zl", "sszj", "fzjgmc",
         "qyjglxmc", "qylxmc", "jgdzzs", "jyfw", "sshymc", "fzrq", "bghzrq", "gszch", "fddbrzjhm", "zzjgdm",
         "jgdzzs_top3", "jgdzzs_top6"),
    "QYFZCHRD": ("swglm", "gljg", "djzclx", "rwbh", "zcdz", "xxtgbmmc"),
    "SGSFRXZXKXX": ("xknr", "xmmc", "splb", "xkjg", "xysyfw", "sjzt2", "xzxkbm", "xkjdswh", "xxtgbmmc"),
    "XKZZNJXX": ("njnd", "njjgmc", "njsxmc", "xxtgbmmc"),
    "ZZDJBGXX": ("zzmc", "zyfw", "rdjgqc", "zzzsbh"),
    "QYSWDJXX": ("fddbrzjmc", "shdw", "qy", "shjg", "djzclx"),
}
ENCODED_COLUMNS = tuple(f"{topic}_{c}" if topic else c for topic, columns in ENCODED.items() for c in columns)


def base_features() -> list[Feature]:
    """People and shares from the base table; all but the row count stay null where nothing is known."""
    return [
        *summary("czbl", F.col("czbl")),
        Feature("QY_tzrgs", "distinct_incl_null", F.col("tzr")),
        Feature("QY_zwzls", "distinct_incl_null", F.col("zw")),
        Feature("QY_fddbrbz_gs", "rows_where", F.col("fddbrbz") == YES),
        Feature("QY_sxdbbz_gs", "rows_where", F.col("sxdbbz") == YES),
        Feature("QYJL_number", "rows", fill=0),
    ]


def topic_features(table: str) -> list[Feature]:
    """The row count of a topic table and, for recruitment, kinds and head counts.

    Kinds of head count are counted on the raw text, statistics on its number.
    """
    topic = TOPICS[table]
    features = [Feature(f"{topic}_number", "rows", fill=0)]
    if table == "recruitment":
        kinds = ("zylb", "gzjy", "gzdd", "zprs", "zwyx", "zdxl", "zprq")
        features += [Feature(f"{topic}_{c}_kinds", "distinct_nullable", F.col(c)) for c in kinds]
        features += summary(f"{topic}_zprs", first_int(F.col("zprs")))
    return features


def _picked(tables: Mapping[str, DataFrame], pick: Pick, latest_by: str) -> DataFrame:
    topic = TOPICS[pick.table]
    if pick.by is None:
        record = first_record(tables[pick.table], KEY, ORDER, pick.columns)
    else:
        by = F.col(pick.by) if latest_by == "text" else parse_timestamp(F.col(pick.by))
        record = latest_record(tables[pick.table], KEY, by, ORDER, pick.columns)
    return record.withColumnsRenamed({c: f"{topic}_{c}" for c in pick.columns})


def build_spine(base: DataFrame) -> DataFrame:
    """One row per enterprise and split: its first base record."""
    return first_record(base, KEY, ORDER, SPINE)


def label(spine: DataFrame, dishonest: DataFrame, punished: DataFrame) -> DataFrame:
    """The two targets, by membership in the name lists of the same split."""
    return membership_flags(spine, {"is_shixin": dishonest, "is_chufa": punished}, KEY)


def with_dates(wide: DataFrame) -> DataFrame:
    """Parse the dates, then add calendar parts, day gaps and the branch-closed flag."""
    parsed = wide.withColumns({
        **{c: parse_day(F.col(c)) for c in ("clrq", "hzrq")},
        **{c: parse_slash_date(F.col(c)) for c in ("fzclsj", "fzswsj")},
        **{c: parse_timestamp(F.col(c)) for c in TOPIC_DATES},
    })
    parts = [date_parts(F.col(c), c) for c in ("clrq", "hzrq", *TOPIC_DATES)]
    return parsed.withColumns({
        **{name: part for group in parts for name, part in group.items()},
        **{name: day_gap(F.col(start), F.col(end)) for name, start, end in GAPS},
        "is_FZ_die": not_null_flag(F.col("fzswsj")),
    })


def text_vectors(tables: Mapping[str, DataFrame]) -> WordVectors:
    """Word vectors of the business scope, over all rounds of train and test."""
    return fit_word_vectors(tables["registration"], F.col("jyfw"))


def build_features(tables: Mapping[str, DataFrame], word_vectors: WordVectors | Word2VecModel | None = None,
                   latest_by: str = "text", approx_kinds: bool = False) -> DataFrame:
    """The whole feature table from the raw tables.

    ``latest_by`` is ``text`` (the raw date text decides) or ``parsed``.
    The wide rows are staged once, before the category codes are taken.
    """
    registration = tables["registration"]
    registration_columns = [c for c in registration.columns if c not in {*KEY, *ORDER, "is_chusai"}]
    branch = tables["branch"]
    branch_columns = [c for c in branch.columns if c not in {*KEY, *ORDER, "is_chusai", *registration_columns}]

    features = {"base": base_features(), **{t: topic_features(t) for t in TOPICS}}
    parts = [
        first_record(branch, KEY, ORDER, branch_columns).withColumn("has_branch", F.lit(1)),
        first_record(registration, KEY, ORDER, registration_columns).withColumn("has_registration", F.lit(1)),
        *[entity_features(tables[t], KEY, spec, approx_kinds) for t, spec in features.items()],
        *[_picked(tables, pick, latest_by) for pick in PICKS],
    ]
    fill = fills([f for spec in features.values() for f in spec])
    spine = label(build_spine(tables["base"]), tables["dishonest"], tables["punished"])
    wide = with_dates(attach(spine, parts, KEY, {**fill, "has_branch": 0, "has_registration": 0}))
    wide = wide.withColumns({
        "jgdzzs_top3": prefix(F.col("jgdzzs"), 3),
        "jgdzzs_top6": prefix(F.col("jgdzzs"), 6),
        **region_code_parts(F.col("xzgh"), "xzgh"),
    })
    wide = document_vectors(wide, word_vectors or text_vectors(tables), F.col("jyfw"),
                            [f"jyfw_array_{i}_fea" for i in range(VECTOR_SIZE)])
    return ordinal_encode(stage(wide, "wide-features"), ENCODED_COLUMNS, KEY)
