"""Digests over canonical text. Decimals have 18 digits of scale, instants ISO form with microseconds, absent values the word None."""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def iso(c: Column, sep: str = "T") -> Column:
    return F.date_format(c, f"yyyy-MM-dd'{sep}'HH:mm:ss.SSSSSS'+00:00'")


def iso_short(c: Column) -> Column:
    """ISO form whose fraction is left out if it is zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(whole, F.when(F.pmod(F.unix_micros(c), F.lit(1_000_000)) == 0, "").otherwise(F.date_format(c, ".SSSSSS")), F.lit("+00:00"))


def digest(parts: Sequence[Column], length: int = 64) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def candle_hash(sep: str = "T") -> Column:
    """Of instant and OHLCV. Two forms are in use, which differ in the letter between date and time."""
    return digest([iso(F.col("ts_utc"), sep), *(text(F.col(c)) for c in ("open", "high", "low", "close", "volume"))])


def candle_policy_hash() -> Column:
    """Of identity, OHLCV and value: what duplicates are told apart by."""
    return digest([text(F.col(c)) for c in ("exchange", "symbol", "timeframe")] + [iso(F.col("ts_utc"), " ")] + [text(F.col(c)) for c in ("open", "high", "low", "close", "volume", "value")])


def metadata_hash(fields: Sequence[str]) -> Column:
    """32 hex digits over the fields that aren't null, as name=value in order of name."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{f}="), F.col(f).cast("string"))) for f in sorted(fields))), 256), 1, 32)


def short_id(*parts: Column) -> Column:
    """16 hex digits: contract, run, snapshot and chunk ids."""
    return digest(parts, 16)


def scaled(c: Column, digits: int) -> Column:
    """``c * 10**digits`` as a whole number, exactly; raises if digits are left over, however far behind the point, or if the result has over 32 digits."""
    if not 0 <= digits <= 18:
        raise ValueError("0 to 18 digits")
    unit = F.lit(Decimal(1).scaleb(-digits)).cast(f"decimal({digits + 1},{digits})")
    whole = (c.cast(f"decimal(38,{digits})") * F.lit(10**digits).cast(f"decimal({digits + 1},0)")).cast("decimal(38,0)")
    return F.when(c % unit == 0, whole).when(c.isNotNull(), F.raise_error(F.concat(F.lit("more digits than the scale: "), c.cast("string"))))


def unscaled(c: Column, digits: int) -> Column:
    """The inverse, for whole numbers of up to 19 digits."""
    return (c.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-digits)).cast("decimal(18,18)" if digits else "decimal(1,0)")).cast(f"decimal(38,{digits})")


def units(c: Column, digits: int) -> Column:
    """``c * 10**digits`` of a decimal with that scale as decimal(38,0), where plain multiplication would run out of digits."""
    fraction = (c % F.lit(1).cast("decimal(1,0)")).cast(f"decimal({digits + 1},{digits})")
    ten = F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    small = (fraction * ten).cast("decimal(38,0)")
    return (F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast(f"decimal({38 - digits},0)").cast("decimal(38,0)") * ten).cast("decimal(38,0)") + small


def half_even(c: Column, digits: int = 18) -> Column:
    """``c`` (a decimal, or its text) at ``digits`` behind the point, ties to the even digit; null for what is no number. A cast rounds ties up."""
    wide = c.try_cast(f"decimal(38,{min(digits + 2, 20)})") if digits < 18 else c.try_cast("decimal(38,20)")
    return F.bround(wide, digits).cast(f"decimal(38,{digits})")
