"""Bounding boxes and raster footprints as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from metaloom.functions.bind import let
from metaloom.functions.variants import child, kind, strip, text_at

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_NOT_FINITE = r"(?i)^[+-]?(nan|inf|infinity)$"
_BLANKS = r"[\s\x1c-\x1f\x85\u00a0]+"


def number(text: Column) -> Column:
    """Strict decimal text to DOUBLE, NULL for anything else."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double")).when(
        trimmed.rlike(_NOT_FINITE), F.lit(float("nan"))
    )


def number_text(text: Column) -> Column:
    """Decimal text as a float prints: `20` to `20.0`, `1e-5` to `1e-05`, `-.50` to `-0.5`.

    Exact for up to 15 significant digits, which covers any coordinate; longer digit strings are first
    rounded to the nearest double.
    """
    trimmed = strip(text)
    value = trimmed.try_cast("double")
    digits = F.length(F.regexp_replace(F.regexp_replace(trimmed, "[eE].*$", ""), r"[+-]|\.", ""))
    exact = F.when(digits <= 15, trimmed).otherwise(value.cast("string"))
    plain = F.regexp_replace(exact.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    sign = F.when(F.startswith(trimmed, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    # Scientific form below 1e-4 and from 1e16: digits, then a signed exponent of two digits at least.
    printed = F.format_string("%.14e", F.abs(value))
    mantissa = F.regexp_replace(F.regexp_extract(printed, r"^([\d.]+)e", 1), r"\.?0+$", "")
    scientific = F.concat(sign, mantissa, F.regexp_extract(printed, r"(e[+-]\d+)$", 1))
    return (
        F.when(value == 0, F.concat(sign, F.lit("0.0")))
        .when((F.abs(value) < 1e-4) | (F.abs(value) >= 1e16), scientific)
        .otherwise(plain)
    )


def box_numbers(box: Column) -> Column:
    return F.split(strip(box), _BLANKS)


def fix_box(box: Column, guess_order: bool = False) -> Column:
    """Four blank-separated numbers become `west,south east,north`; any other text stays as it is.

    The numbers are taken as west, south, east, north. With `guess_order` they are taken as south, west, north,
    east where the second or fourth is no latitude, as `check_box` reads them.
    """

    def joined(parts: Column) -> Column:
        fits = (
            (F.size(parts) == 4)
            & ~F.contains(box, F.lit(","))
            & F.forall(parts, lambda p: p.rlike(_NUMBER))
        )
        if guess_order:
            latitudes = [F.get(parts, F.lit(i)).try_cast("double").between(-90, 90) for i in (1, 3)]
            turned = F.array(*[F.get(parts, F.lit(i)) for i in (1, 0, 3, 2)])
            parts = F.when(latitudes[0] & latitudes[1], parts).otherwise(turned)
        return F.when(
            fits,
            let(
                F.transform(parts, number_text),
                lambda n: F.concat(
                    F.array_join(F.slice(n, 1, 2), ","), F.lit(" "), F.array_join(F.slice(n, 3, 2), ",")
                ),
            ),
        ).otherwise(box)

    return let(box_numbers(box), joined)


def in_range(west: Column, south: Column, east: Column, north: Column) -> Column:
    return (
        south.between(-90, 90)
        & north.between(-90, 90)
        & west.between(-180, 180)
        & east.between(-180, 180)
    )


# Messages of the box check.
OUT_OF_RANGE = "box out of range"
BAD_FORMAT = "invalid box format"
BAD_NUMBERS = "invalid box numbers"
BAD_COUNT = "box expected 2 or 4 numbers"


def check_box(box: Column) -> Column:
    """STRUCT<ok, msg, west, south, east, north, order_guessed> for a box text.

    Two parts are read as `west,south east,north`. Four numbers are read in that order if the second
    and fourth are latitudes, else as south, west, north, east. An empty text is fine.
    """

    def texts(parts: Column) -> Column:
        """The four number texts in box order, or NULL if the text has another shape."""
        pairs = F.flatten(F.transform(parts, lambda p: F.split(p, ",")))
        two_each = F.forall(parts, lambda p: F.size(F.split(p, ",")) == 2)
        return F.when(F.size(parts) == 4, parts).when((F.size(parts) == 2) & two_each, pairs)

    def ordered(n: Column, four: Column) -> Column:
        """Numbers as west, south, east, north."""
        given = [F.get(n, F.lit(i)) for i in range(4)]
        swapped = four & ~(given[1].between(-90, 90) & given[3].between(-90, 90))
        turned = F.array(given[1], given[0], given[3], given[2])
        return F.when(F.exists(n, lambda x: x.isNull()), F.lit(None)).otherwise(
            F.when(swapped, turned).otherwise(n)
        )

    def verdict(parts: Column, found: Column, numbers: Column) -> Column:
        four = F.size(parts) == 4
        west, south, east, north = (F.get(numbers, F.lit(i)) for i in range(4))
        msg = (
            F.when(F.coalesce(strip(box), F.lit("")) == "", F.lit(None).cast("string"))
            .when(found.isNull(), F.lit(BAD_COUNT))
            .when(numbers.isNull(), F.when(four, F.lit(BAD_NUMBERS)).otherwise(F.lit(BAD_FORMAT)))
            .when(~in_range(west, south, east, north), F.lit(OUT_OF_RANGE))
        )
        return let(
            msg,
            lambda m: F.struct(
                m.isNull().alias("ok"),
                m.alias("msg"),
                F.when(m.isNull(), west).alias("west"),
                F.when(m.isNull(), south).alias("south"),
                F.when(m.isNull(), east).alias("east"),
                F.when(m.isNull(), north).alias("north"),
                F.coalesce(four & numbers.isNotNull(), F.lit(False)).alias("order_guessed"),
            ),
        )

    return let(
        box_numbers(F.coalesce(box, F.lit(""))),
        lambda parts: let(
            texts(parts),
            lambda found: let(
                ordered(F.transform(found, number), F.size(parts) == 4),
                lambda numbers: verdict(parts, found, numbers),
            ),
        ),
    )


def box_of(doc: Column) -> Column:
    """The box text of a document: only if each level is an object and the box a string."""
    nested = (kind(child(doc, "$.spatialCoverage")) == "OBJECT") & (
        kind(child(doc, "$.spatialCoverage.geo")) == "OBJECT"
    )
    return F.when(nested, strip(text_at(doc, "$.spatialCoverage.geo.box")))


def box_from_columns(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column) -> Column:
    """`lonmin,latmin lonmax,latmax`, or '' without a first longitude."""

    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    return F.when(
        text(lon_min) != "",
        F.concat(text(lon_min), F.lit(","), text(lat_min), F.lit(" "), text(lon_max), F.lit(","), text(lat_max)),
    ).otherwise(F.lit(""))


def with_footprint(headers: DataFrame) -> DataFrame:
    """Bounds of each raster from its origin (upper left), size in cells and resolution."""
    return (
        headers.withColumn("west", F.col("origin_x").cast("double"))
        .withColumn("north", F.col("origin_y").cast("double"))
        .withColumn("east", F.col("origin_x") + F.col("width") * F.abs("res_x"))
        .withColumn("south", F.col("origin_y") - F.col("height") * F.abs("res_y"))
    )


def collection_extent(headers: DataFrame, key: str = "collection") -> DataFrame:
    """Union extent of all rasters of a collection."""
    return (
        with_footprint(headers)
        .groupBy(key)
        .agg(
            F.min("west").alias("west"),
            F.min("south").alias("south"),
            F.max("east").alias("east"),
            F.max("north").alias("north"),
        )
    )


def round_extent(headers: DataFrame, key: str = "collection") -> DataFrame:
    """Extent of all rasters of a collection on the globe: west > east where it lies over the date line.

    Longitudes are arcs of a circle. The union of all arcs leaves gaps; the extent is what lies outside the largest
    (of equal ones the first east of -180). Without a gap it is the whole circle, -180 to 180. Arcs are first reduced to the longest
    at each western edge, which partial aggregates do, so a collection of very many tiles on a grid meets as few rows.
    """
    tiles = with_footprint(headers)
    width = F.least(F.col("east") - F.col("west"), F.lit(360.0))
    west = F.pmod(F.col("west").cast("double") + 180, F.lit(360.0)) - 180
    edges = tiles.groupBy(key, west.alias("_west")).agg(
        F.max(width).alias("_width"), F.min("south").alias("south"), F.max("north").alias("north")
    )
    line = Window.partitionBy(key).orderBy("_west")
    reach = F.max(F.col("_west") + F.col("_width"))
    whole = Window.partitionBy(key)
    # What the arcs over the date line cover of the circle's beginning counts as the first end.
    placed = edges.select(
        key,
        "_west",
        "south",
        "north",
        F.greatest(reach.over(line.rowsBetween(Window.unboundedPreceding, -1)), reach.over(whole) - 360).alias("_past"),
        reach.over(whole).alias("_end"),
        F.min("_west").over(whole).alias("_first"),
    )
    # The gap before each arc; that of the first reaches back over the date line to the last end.
    gap = F.when(F.col("_west") > F.col("_first"), F.col("_west") - F.col("_past")).otherwise(F.col("_west") + 360 - F.col("_end"))
    begin = F.when(F.col("_west") > F.col("_first"), F.col("_past")).otherwise(F.col("_end"))
    normal = F.pmod(begin + 180, F.lit(360.0)) - 180
    best = F.max_by(F.struct(F.col("_west").alias("west"), normal.alias("end")), F.struct(gap.alias("gap"), (-F.col("_west")).alias("place")))
    found = placed.groupBy(key).agg(best.alias("_best"), F.max(gap).alias("_gap"), F.min("south").alias("south"), F.max("north").alias("north"))
    open_ = F.col("_gap") > 0
    east = F.when(F.col("_best")["end"] == -180, F.lit(180.0)).otherwise(F.col("_best")["end"])
    return found.select(
        key,
        F.when(open_, F.col("_best")["west"]).otherwise(F.lit(-180.0)).alias("west"),
        "south",
        F.when(open_, east).otherwise(F.lit(180.0)).alias("east"),
        "north",
    )
