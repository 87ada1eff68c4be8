"""Place of an IPv4 or IPv6 address from supplied tables of address ranges and networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from watchtide.functions.text import text

GEO_SCHEMA = (
    "start BIGINT, end BIGINT, country STRING, state STRING, city STRING, latitude DOUBLE, longitude DOUBLE"
)
#: A network is an address and a prefix length, such as ``2001:db8::/32``.
NETWORK_SCHEMA = "network STRING, country STRING, state STRING, city STRING, latitude DOUBLE, longitude DOUBLE"
PLACE = {
    "EnrichedCountry": "country",
    "EnrichedState": "state",
    "EnrichedCity": "city",
    "EnrichedLatitude": "latitude",
    "EnrichedLongitude": "longitude",
}
GEO_COLUMNS = tuple(PLACE)
_NUMBERS = ("EnrichedLatitude", "EnrichedLongitude")

# Ranges are cut up by blocks of 2^8 addresses; an address meets the pieces of its own block only. Wide ranges are
# spread over blocks of 2^16 addresses first, so that no array of blocks grows beyond 2^16.
BLOCK_BITS, WIDE_BITS = 8, 16


def ipv4_number(address: Column) -> Column:
    """The address as a number, null when it is not a dotted IPv4 address."""
    parts = F.split(address, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("long") for i in range(4)]
    shaped = F.rlike(address, F.lit(r"^\d{1,3}(\.\d{1,3}){3}$"))
    small = F.greatest(*octets) <= 255
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(shaped & small, number)


def ipv6_bits(address: Column) -> Column:
    """The 128 bits of an IPv6 address as text, null when it is not one. The last two groups may be a dotted IPv4 address."""
    dotted = F.regexp_extract(address, r":(\d{1,3}(?:\.\d{1,3}){3})$", 1)
    number = ipv4_number(dotted)
    tail = F.concat_ws(":", F.lower(F.hex(F.shiftright(number, 16))), F.lower(F.hex(number.bitwiseAND(F.lit(65535)))))
    whole = F.when(number.isNotNull(), F.concat(F.regexp_replace(address, r"[^:]*$", ""), tail)).when(dotted == "", address)
    halves = F.split(whole, "::", -1)
    groups = lambda i: F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    left, right = groups(0), groups(1)
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
    bits = F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(F.conv(g, 16, 2), 16, "0")), "")
    shaped = F.rlike(whole, F.lit(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"))
    short = F.rlike(whole, F.lit(r"^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?$"))
    return F.when(shaped | (short & (F.size(left) + F.size(right) <= 7)), bits)


def without_geo(df: DataFrame) -> DataFrame:
    """Empty place columns, for runs without a range table."""
    return df.withColumns(
        {name: F.lit(None).cast("double") if name in _NUMBERS else F.lit("") for name in GEO_COLUMNS}
    )


def _blocks(df: DataFrame, bits: int) -> DataFrame:
    """Ranges cut at the borders of blocks of ``2 ** bits`` addresses."""
    size = F.lit(1 << bits)
    spread = df.withColumn("_block", F.explode(F.sequence(F.shiftright("_from", bits), F.shiftright("_to", bits))))
    low = F.greatest("_from", F.col("_block") * size)
    high = F.least("_to", F.col("_block") * size + size - 1)
    return spread.withColumns({"_from": low, "_to": high})


_PIECES = "_block BIGINT, _start BIGINT, _end BIGINT, _place STRUCT<" + ", ".join(
    f"{n}: {'DOUBLE' if n in _NUMBERS else 'STRING'}" for n in PLACE
) + ">"
_NETS = _PIECES.replace("_block BIGINT, _start BIGINT, _end BIGINT", "_prefix STRING")


def _place() -> Column:
    return F.struct(*[F.col(source).alias(name) for name, source in PLACE.items()]).alias("_place")


class GeoRanges:
    """Range table (``GEO_SCHEMA``, both ends inclusive) prepared for one equality join, and IPv6 networks for another.

    The most specific range wins where ranges overlap, of equal ones the first. Overlaps are resolved here once, block
    by block: the pieces that come out are disjoint, so an address has one piece at most and a row stays one row.
    Networks (``NETWORK_SCHEMA``) are named by their leading bits, and the longest name that an address begins with
    wins. ``save`` writes both; ``load`` takes them up again, and nothing is resolved anew.
    """

    def __init__(self, ranges: DataFrame, networks: DataFrame | None = None):
        named = ranges.filter(F.col("start") <= F.col("end")).select(
            F.col("start").alias("_from"),
            F.col("end").alias("_to"),
            F.struct((F.col("end") - F.col("start")).alias("width"), F.col("start").alias("start")).alias("_order"),
            _place(),
        )
        cells = _blocks(_blocks(named, WIDE_BITS), BLOCK_BITS)
        edges = cells.select("_block", F.explode(F.array(F.col("_from"), F.col("_to") + 1)).alias("_start")).distinct()
        following = F.lead("_start").over(Window.partitionBy("_block").orderBy("_start"))
        pieces = edges.withColumn("_end", following - 1).filter(F.col("_end").isNotNull())
        covering = pieces.join(cells, "_block").filter(F.col("_start").between(F.col("_from"), F.col("_to")))
        self.pieces = covering.groupBy("_block", "_start", "_end").agg(F.min_by("_place", "_order").alias("_place"))
        self.nets = None
        if networks is not None:
            parts = F.split("network", "/")
            bits, length = ipv6_bits(F.get(parts, F.lit(0))), F.get(parts, F.lit(1)).try_cast("int")
            named = networks.select(F.when(length.between(0, 128), F.substring(bits, F.lit(1), length)).alias("_prefix"), _place())
            self.nets = named.filter("_prefix is not null").groupBy("_prefix").agg(F.min("_place").alias("_place"))

    def save(self, path: str) -> None:
        """Writes the resolved pieces by block, and the networks, in place of older ones."""
        self.pieces.repartition("_block").sortWithinPartitions("_block", "_start").write.mode("overwrite").parquet(f"{path}/pieces")
        nets = self.nets if self.nets is not None else self.pieces.sparkSession.createDataFrame([], _NETS)
        nets.write.mode("overwrite").parquet(f"{path}/networks")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GeoRanges:
        """The ranges that ``save`` wrote."""
        found = cls.__new__(cls)
        found.pieces = spark.read.schema(_PIECES).parquet(f"{path}/pieces")
        found.nets = spark.read.schema(_NETS).parquet(f"{path}/networks")
        return found

    def enrich(self, df: DataFrame, address: str, spread_by: str = "FindingId") -> DataFrame:
        """``df`` with the place columns; row for row the same otherwise.

        Rows without an address of a join's kind get keys of their own, so they do not meet in one task.
        """
        number, apart = ipv4_number(F.col(address)), F.pmod(F.xxhash64(spread_by), F.lit(1 << 20))
        keyed = df.withColumns({"_number": number, "_block": F.coalesce(F.shiftright(number, BLOCK_BITS), -1 - apart)})
        inside = (keyed["_block"] == self.pieces["_block"]) & keyed["_number"].between(F.col("_start"), F.col("_end"))
        placed = keyed.join(self.pieces, inside, "left").select(*df.columns, "_place")
        if self.nets is not None:
            bits = F.coalesce(ipv6_bits(F.col(address)), F.concat(F.lit("-"), apart.cast("string")))
            placed = placed.withColumn("_bits", bits).join(self._placed6(df.select(ipv6_bits(F.col(address)).alias("_bits"))), "_bits", "left")
            placed = placed.withColumn("_place", F.coalesce("_place", "_place6"))
        place = {n: F.col(f"_place.{n}") for n in GEO_COLUMNS}
        return placed.select(*df.columns, *[(c if n in _NUMBERS else text(c)).alias(n) for n, c in place.items()])

    def _placed6(self, bits: DataFrame) -> DataFrame:
        """``(_bits, _place6)`` of every IPv6 address that a network holds, each address once."""
        # There are 129 lengths at most, however many networks.
        lengths = sorted(r[0] for r in self.nets.select(F.length("_prefix")).distinct().collect())
        names = F.explode(F.array(*[F.substring("_bits", 1, n) for n in lengths]).cast("array<string>")).alias("_prefix")
        tried = bits.filter("_bits is not null").distinct().select("_bits", names)
        found = tried.join(self.nets.withColumnRenamed("_place", "_place6"), "_prefix")
        return found.groupBy("_bits").agg(F.max_by("_place6", F.length("_prefix")).alias("_place6"))
