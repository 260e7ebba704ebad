"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark import fixtures as fx
from lakespark.operators import qa
from lakespark.session import configure

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

DECIMALS = 8


def shape(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Comparable output: rounded doubles, longs for whole numbers and booleans."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), decimals) + F.lit(0.0)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").cast("long")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, decimals: int = DECIMALS):
    def register(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return shape(fn(configure(spark, wide=True), sf), decimals)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL text helpers --------------------------------------------------------------------


def r(expr: str, name: str | None = None, decimals: int = DECIMALS) -> str:
    return f"round(cast({expr} as double), {decimals}) + 0e0 as {name or expr}"


def i(expr: str, name: str | None = None) -> str:
    return f"cast({expr} as bigint) as {name or expr}"


def many(fn, names) -> str:
    return ", ".join(fn(n) for n in names)


INDEXED = """select *,
  rhos_620 is not null and rhos_665 is not null and rhos_681 is not null and rhos_709 is not null as fin,
  case when fin then rhos_681 - rhos_665 - (rhos_709 - rhos_665)*cast(16e0/44e0 as float) end as ss681,
  case when fin then rhos_665 - rhos_620 - (rhos_681 - rhos_620)*cast(45e0/61e0 as float) end as ss665,
  coalesce(ss681 < cast(0 as float), false) as cand0,
  case when cand0 then -ss681 end as ci0,
  coalesce(ss665 > cast(0 as float) and ci0 > cast(0.0001e0 as float), false) as det0,
  case when det0 then ci0 end as cy0,
  abs(rhos_709 + rhos_665) > cast(1e-8 as float) as nd_ok0,
  coalesce(nd_ok0, false) as nd_ok,
  case when nd_ok then cast(cast(rhos_709 - rhos_665 as double)/cast(rhos_709 + rhos_665 as double) as float) end as nd0,
  cast(rhos_665 as double) as d665, cast(rhos_884 as double) as d884,
  cast(rhos_754 as double) - (d665 + (cast(rhos_865 as double) - d665)*(89e0/200e0)) as fai0,
  cast(rhos_681 as double) - (d665 + (d884 - d665)*(16e0/219e0)) as h681,
  cast(rhos_709 as double) - (d665 + (d884 - d665)*(44e0/219e0)) as h709,
  cast(rhos_754 as double) - (d665 + (d884 - d665)*(89e0/219e0)) as h754,
  greatest(h681, h709, h754) as mph0,
  case when h681 = mph0 then 681 when h709 = mph0 then 709 when h754 = mph0 then 754 end as peak0,
  (l2_flags & 1) <> 0 as land, (l2_flags & 2) <> 0 as cld, (l2_flags & 4) <> 0 as sat, (l2_flags & 8) <> 0 as nav
from pixels"""


def native_sql(source: str = "indexed", adjacent: str = "false", bright: str = "false") -> str:
    """Native QA of every pixel of ``source`` that lies in a lake."""
    return f"""select *, not land and not sat and not nav as open_view,
  det0 and coalesce(fai0 > 0, false) and coalesce(rhos_754 > rhos_490, false) as evidence,
  open_view and cld and evidence as rescue1,
  open_view and not cld as strict1,
  not land and cld and not rescue1 as cloud_excluded_mask,
  (strict1 or rescue1) and not ({adjacent}) and not ({bright}) as valid_water_mask,
  strict1 and not ({adjacent}) and not ({bright}) as cyan_strict_valid_mask,
  rescue1 and not ({bright}) as bloom_rescue_mask,
  cld as cldice_mask, sat as hisatzen_mask, nav as navfail_mask,
  valid_water_mask and fin as ci_valid_mask,
  ci_valid_mask and cand0 as ci_candidate_mask,
  ci_valid_mask and det0 as ci_detection_mask,
  valid_water_mask and nd_ok as ndci_valid_mask,
  valid_water_mask and mph0 is not null as mph_valid_mask,
  valid_water_mask and fai0 is not null as fai_valid_mask,
  rhos_884 as rhos_885,
  case when ci_valid_mask then ss681 end as SS_681, case when ci_valid_mask then ss665 end as SS_665,
  case when ci_candidate_mask then ci0 end as CI, case when ci_detection_mask then cy0 end as CI_cyano,
  case when ndci_valid_mask then nd0 end as NDCI,
  case when mph_valid_mask then cast(mph0 as float) end as MPH,
  case when mph_valid_mask then peak0 end as MPH_peak_nm,
  case when fai_valid_mask then cast(fai0 as float) end as FAI
from {source} where hylak_id > 0"""


NATIVE = native_sql()

DENSE = """select *, true as geolocated, not land as water, nav as flag_excluded, qa_x as qa_excluded,
  water and not qa_excluded as valid_water_mask,
  valid_water_mask and fin as ci_valid_mask, valid_water_mask and nd_ok as ndci_valid_mask,
  ci_valid_mask and cand0 as cand1, ci_valid_mask and det0 as det1
from (select *, nav or coalesce(rhos_865 > cast(0.03e0 as float), false) as qa_x,
        coalesce(rhos_865 > cast(0.03e0 as float), false) as bright from indexed)"""


def sql(body: str, views=("pixels",), **ctes: str) -> str:
    return fx.with_clause(views, ctes) + "\n" + body


def native(spark: SparkSession, sf: str, **options) -> DataFrame:
    return qa.native_qa(fx.pixels(spark, sf), fx.FLAG_MAP, **options)


def dense(spark: SparkSession, sf: str, **options) -> DataFrame:
    options.setdefault("mode", "l2_land")
    options.setdefault("bright_screen", True)
    options.setdefault("bright_limit", 0.03)
    return qa.build_dense_indices(fx.pixels(spark, sf), fx.FLAG_MAP, **options)
