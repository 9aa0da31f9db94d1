"""The site table: routing, selection, lookup, per-site extractors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagelake.operators.skew import first_per_group
from pagelake.schemas import SITE

DEFAULT_PAGE_LIMIT = 100
DEFAULT_WAIT_TIME = 5
# Fixed value: the error text of an unknown site.
NOT_FOUND = "Website configuration not found for "

_FIELDS = ("name", "url", "dynamic", "page_limit", "wait_time")


def site_table(spark: SparkSession, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    """Sites from config dicts; unknown keys go to ``extra``. ``ord`` keeps config order."""
    data = [
        (
            *(row.get(f) for f in _FIELDS),
            {k: str(v) for k, v in row.items() if k not in _FIELDS},
            i,
        )
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, SITE + ", ord INT")


def with_defaults(sites: DataFrame, page_limit: int | None = DEFAULT_PAGE_LIMIT) -> DataFrame:
    """Fills limits and routes a site to the ``static`` or ``dynamic`` crawler kind.

    With ``page_limit=None`` a site without a limit of its own has none.
    """
    return sites.withColumns({
        "kind": F.when(F.coalesce("dynamic", F.lit(False)), "dynamic").otherwise("static"),
        "page_limit": F.coalesce("page_limit", F.lit(page_limit).cast("int")),
        "wait_time": F.coalesce("wait_time", F.lit(DEFAULT_WAIT_TIME)),
    })


def select_sites(sites: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The named sites, or all of them when no name is given."""
    wanted = list(names or ())
    return sites.filter(F.col("name").isin(wanted)) if wanted else sites


def first_by_name(sites: DataFrame) -> DataFrame:
    """The first config row of each name."""
    return first_per_group(sites, ["name"], ["ord"])


def lookup_sites(requests: DataFrame, sites: DataFrame, page_limit: int | None = DEFAULT_PAGE_LIMIT) -> DataFrame:
    """``requests(name)`` with the config of each name; an unknown name is a failed row.

    Both tables are configuration; Catalyst broadcasts the smaller one when its
    size allows and shuffles by name otherwise.
    """
    config = with_defaults(first_by_name(sites), page_limit).withColumn("_known", F.lit(True))
    found = F.col("_known").isNotNull()
    return (
        requests.join(config, "name", "left")
        .withColumns({
            "success": found,
            "error": F.when(~found, F.concat(F.lit(NOT_FOUND), "name")),
        })
        .drop("_known")
    )


def unknown_sites(requests: DataFrame, sites: DataFrame) -> DataFrame:
    """Only the failed rows of ``lookup_sites``."""
    missing = requests.join(sites.select("name"), "name", "left_anti")
    return missing.select(
        "name",
        F.lit(False).alias("success"),
        F.concat(F.lit(NOT_FOUND), "name").alias("error"),
    )


class Extractors:
    """Per-site extractors on top of a default one.

    An extractor is a set of columns over the default's result, ``register_fields``, or, where that can't say it, a site's own DataFrame
    function in place of the default, ``register``. Fields are shared by any number of sites and cost
    one scan and one parse for all of them; each function costs a scan of its own. Added columns are
    null for the other sites.
    """

    def __init__(self, default: Callable[[DataFrame], DataFrame]):
        self.default = default
        self._by_site: dict[str, Callable[[DataFrame], DataFrame]] = {}
        self._fields: dict[str, Mapping[str, Column]] = {}

    def register(self, site: str, extractor: Callable[[DataFrame], DataFrame]) -> None:
        self._by_site[site] = extractor

    def register_fields(self, route: str, fields: Mapping[str, Column]) -> None:
        """Columns for the pages that are routed to ``route``."""
        self._fields[route] = fields

    def apply(self, pages: DataFrame, sites: DataFrame | None = None, route: str = "extractor") -> DataFrame:
        """The default's columns and those of the extractors.

        A page's route is what its site says under ``route`` in ``sites(name, extra)``, else the site's name.
        """
        names = list(self._by_site)
        rest = pages.filter(~F.col("site").isin(names)) if names else pages
        parts = [self._with_fields(self.default(rest), sites, route)] + [
            fn(pages.filter(F.col("site") == name)) for name, fn in self._by_site.items()
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _with_fields(self, parsed: DataFrame, sites: DataFrame | None, route: str) -> DataFrame:
        if not self._fields:
            return parsed
        if sites is None:
            routed = parsed.withColumn("_route", F.col("site"))
        else:
            config = sites.select(F.col("name").alias("site"), F.col("extra")[route].alias("_route"))
            routed = parsed.join(config, "site", "left").withColumn("_route", F.coalesce("_route", "site"))
        columns: dict[str, Column] = {}
        for name, fields in self._fields.items():
            for field, value in fields.items():
                chosen = columns[field] if field in columns else F
                columns[field] = chosen.when(F.col("_route") == name, value)
        return routed.withColumns(columns).drop("_route")
