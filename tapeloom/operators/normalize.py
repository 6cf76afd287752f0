"""Raw messages and log entries to typed trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import browser_number, browser_text, parse_float, parse_int

# Type and default of each log field.
FIELD_DEFAULTS = {
    "ts": ("bigint", 0),
    "price": ("double", 0.0),
    "qty": ("double", 0.0),
    "side": ("string", "buy"),
    "ofi": ("double", 0.0),
}

BODY = "body"


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that filters further up read but never compute again.

    The optimizer moves a filter below a projection by repeating the projected
    expressions in it, which would parse every message twice. It does not move
    one below a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def parse(frames: DataFrame, column: str = "value") -> DataFrame:
    """Add ``body``, the message as a VARIANT; NULL where the text is no JSON."""
    return once(frames, {BODY: F.try_parse_json(column)})


def _text(key: str) -> Column:
    return F.try_variant_get(BODY, f"$.{key}", "string")


def _variant(key: str) -> Column:
    return F.try_variant_get(BODY, f"$.{key}", "variant")


def _kind(key: str) -> Column:
    return F.schema_of_variant(_variant(key))


def checked(frames: DataFrame) -> DataFrame:
    """Every frame with the trade columns and ``reason``, in one parse.

    ``reason`` says why a frame cannot become a trade, NULL if it can.
    """
    found = once(
        parse(frames),
        {"T": _text("T"), "p": _text("p"), "q": _text("q"), "m": _text("m"), "m_kind": _kind("m")},
    )
    # Equality with false: the boolean itself, or a number equal to zero.
    maker_false = (F.col("m") == "false") & (F.col("m_kind") == "BOOLEAN")
    maker_zero = (F.col("m").try_cast("double") == 0) & ~F.col("m_kind").isin("BOOLEAN", "STRING", "VOID")
    typed = once(
        found,
        {
            "ts": F.col("T").try_cast("bigint"),
            "price": parse_float(F.col("p")),
            "qty": parse_float(F.col("q")),
            "side": F.when(maker_false | maker_zero, "buy").otherwise("sell"),
        },
    )
    reason = (
        F.when(F.col(BODY).isNull(), "not json")
        .when(F.col("T").isNull(), "missing T")
        .when(F.col("p").isNull(), "missing p")
        .when(F.col("q").isNull(), "missing q")
        .when(F.col("m_kind").isNull(), "missing m")
        .when(F.col("ts").isNull(), "bad ts")
        .when(F.col("price").isNull(), "bad price")
        .when(F.col("qty").isNull(), "bad qty")
    )
    return typed.withColumn("reason", reason).select(*frames.columns, "ts", "price", "qty", "side", "reason")


def trades_of(checked_frames: DataFrame) -> DataFrame:
    return checked_frames.where(F.col("reason").isNull()).drop("reason", "value")


def rejects_of(checked_frames: DataFrame) -> DataFrame:
    return checked_frames.where(F.col("reason").isNotNull()).drop("ts", "price", "qty", "side")


def normalize(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(trades, rejects)`` of raw frames ``[seq, value, ...]``."""
    both = checked(frames)
    return trades_of(both), rejects_of(both)


def normalize_strict(frames: DataFrame) -> DataFrame:
    """Trades only; the first bad frame fails the job."""
    both = checked(frames)
    guard = F.when(
        F.col("reason").isNotNull(),
        F.raise_error(F.concat(F.lit("bad trade message: "), F.col("reason"))).cast("bigint"),
    ).otherwise(F.col("ts"))
    return both.withColumn("ts", guard).drop("reason", "value")


def normalize_dialects(frames: DataFrame) -> DataFrame:
    """Trades from long (``ts, price, qty, side``) or short (``T, p, q, m``) keys.

    Long keys win unless absent or null. Frames that are not JSON or whose ts,
    price or qty is no number are dropped. Side is clamped to buy or sell.
    """

    pairs = {"ts": "T", "price": "p", "qty": "q"}
    found = once(parse(frames), {f"_{k}": _text(k) for k in (*pairs, *pairs.values(), "side", "m", "id")})

    def pick(long: str, short: str) -> Column:
        long_text, short_text = F.col(f"_{long}"), F.col(f"_{short}")
        return (
            F.when(long_text.isNotNull(), browser_number(long_text, _kind(long) == "BOOLEAN"))
            .when(short_text.isNotNull(), browser_number(short_text, _kind(short) == "BOOLEAN"))
            # A null that is spelled out counts as zero, an absent key as no number.
            .when(F.is_variant_null(_variant(short)), F.lit(0.0))
        )

    maker_false = (F.col("_m") == "false") & (_kind("m") == "BOOLEAN")
    side = F.coalesce("_side", F.when(maker_false, "buy").otherwise("sell"))
    parsed = once(
        found,
        {
            **{long: pick(long, short) for long, short in pairs.items()},
            "side": F.when(side == "buy", "buy").otherwise("sell"),
        },
    )
    kept = parsed.where("ts IS NOT NULL AND price IS NOT NULL AND qty IS NOT NULL")
    # The arrival position stands in for a wall clock, so ids are reproducible.
    made = F.concat_ws("-", F.col("ts").cast("bigint"), browser_text(F.col("qty")), browser_text(F.col("price")), "seq")
    return kept.withColumns(
        {"id": F.coalesce("_id", made), "ts": F.col("ts").cast("bigint")}
    ).select(*[c for c in frames.columns if c != "value"], "id", "ts", "price", "qty", "side")


def coerce_fields(entries: DataFrame, column: str = "fields") -> DataFrame:
    """Typed columns of a log entry's string map.

    A default stands in for an absent field only; text that does not parse
    fails the job.
    """

    def field(name: str) -> Column:
        kind, default = FIELD_DEFAULTS[name]
        raw = F.try_element_at(F.col(column), F.lit(name))
        if kind == "string":
            value = raw
        else:
            parsed = parse_int(raw) if kind == "bigint" else parse_float(raw)
            complaint = F.concat(F.lit(f"bad {name}: "), raw)
            value = F.when(raw.isNotNull() & parsed.isNull(), F.raise_error(complaint).cast(kind)).otherwise(parsed)
        return F.coalesce(value, F.lit(default).cast(kind)).alias(name)

    rest = [F.col(c) for c in entries.columns if c != column]
    return entries.select(*rest, *[field(n) for n in FIELD_DEFAULTS])
