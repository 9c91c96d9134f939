"""As-of choice of a data version for a requested model version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_VERSION = "N/A"

# Fixed format: the published grammar of Python package versions, in groups: epoch, release, kind and
# number of a pre-release, number of a post-release (short and long form), number of a development
# release, local label. A data folder's name has three parts between dots; a request at least a major.
_VERSION = (
    r"(?i)^v*(?:(\d+)!)?(\d+(?:\.\d+)*)(?:[-_.]?(alpha|a|beta|b|preview|pre|c|rc)[-_.]?(\d*))?"
    r"(?:-(\d+)|[-_.]?(post|rev|r)[-_.]?(\d*))?(?:[-_.]?(dev)[-_.]?(\d*))?(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?$"
)
_REQUEST = r"^v*(?:\d+!)?(\d+)(?:\.(\d+))?"


def _part(name: str, pattern: str, index: int) -> Column:
    return F.regexp_extract(name, pattern, index).try_cast("bigint")


def release_order(name: str) -> Column:
    """A struct that sorts version names: development releases before pre-releases (alpha, beta, candidate), these
    before the release, and that before its post-releases; NULL for what is no version."""
    def text(index: int) -> Column:
        return F.lower(F.regexp_extract(name, _VERSION, index))

    def number(index: int) -> Column:
        return F.coalesce(_part(name, _VERSION, index), F.lit(0).cast("bigint"))

    release = F.split(text(2), r"\.")
    pre, post, dev = text(3), (text(5) != "") | (text(6) != ""), text(8) != ""
    kind = (
        F.when(pre.isin("a", "alpha"), 0)
        .when(pre.isin("b", "beta"), 1)
        .when(pre != "", 2)
        .when(dev & ~post, -1)
        .otherwise(3)
    )
    key = F.struct(
        number(1).alias("epoch"),
        *[F.coalesce(F.get(release, F.lit(i)).try_cast("bigint"), F.lit(0).cast("bigint")).alias(n) for i, n in enumerate(("major", "minor", "patch"))],
        kind.alias("stage"),
        F.when(pre != "", number(4)).otherwise(0).alias("stage_number"),
        F.when(post, F.greatest(number(5), number(7))).otherwise(-1).alias("post"),
        F.when(dev, number(9)).otherwise((1 << 62)).alias("dev"),
        text(10).alias("local"),
    )
    return F.when(F.col(name).rlike(_VERSION), key)


def newest_per_minor(catalogue: DataFrame, name: str = "name") -> DataFrame:
    """``(major, minor, newest)``: the newest version of every minor one, as (order, name).

    Names that are no versions, or have not three parts between dots, are passed over.
    """
    versions = catalogue.where(F.size(F.split(name, r"\.")) == 3).select(release_order(name).alias("order"), F.col(name).alias("name"))
    return (
        versions.where(F.col("order").isNotNull())
        .groupBy(F.col("order.major").alias("major"), F.col("order.minor").alias("minor"))
        .agg(F.max(F.struct("order", "name")).alias("newest"))
    )


def resolve_versions(
    requests: DataFrame, catalogue: DataFrame, request: str = "model_version", name: str = "name"
) -> DataFrame:
    """Add ``data_version`` to ``requests``.

    It is the newest version of the requested major.minor, else the newest of all minor versions before
    it, which may belong to an earlier major, else ``"N/A"``. Pre-releases count as versions and come before
    their release. Both sides are reduced to distinct minor versions first; requests and versions then meet in one
    ordered pass per major, and majors in one over a row each, so there is no pairing of the two.
    """
    asked = requests.select(
        F.col(request),
        _part(request, _REQUEST, 1).alias("major"),
        F.coalesce(_part(request, _REQUEST, 2), F.lit(0)).alias("minor"),
    ).distinct()
    timeline = (
        newest_per_minor(catalogue, name)
        .unionByName(asked.select("major", "minor").distinct(), allowMissingColumns=True)
        .groupBy("major", "minor")
        .agg(F.max("newest").alias("newest"))
    )
    earlier = Window.partitionBy("major").orderBy("minor").rowsBetween(Window.unboundedPreceding, -1)
    within = timeline.select("major", "minor", "newest", F.max("newest").over(earlier).alias("_within"))
    before = Window.orderBy("major").rowsBetween(Window.unboundedPreceding, -1)
    carried = timeline.groupBy("major").agg(F.max("newest").alias("best")).select("major", F.max("best").over(before).alias("_carried"))
    found = F.coalesce(F.col("newest"), F.greatest("_within", "_carried"))
    resolved = (
        asked.join(within, ["major", "minor"], "left")
        .join(carried, "major", "left")
        .select(request, F.coalesce(found["name"], F.lit(NO_VERSION)).alias("data_version"))
    )
    return requests.join(resolved, request, "left").withColumn(
        "data_version", F.coalesce("data_version", F.lit(NO_VERSION))
    )
