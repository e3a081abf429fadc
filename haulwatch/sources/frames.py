"""Binary position frames (one hex text per message) to rows, as column expressions.

A frame is header (12 bytes, 16 with sub-package fields), body, one checksum byte. All
fields are cut from the hex text, so decoding runs inside the JVM and scales with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions import timefn

# Message ids of the protocol.
MSG_LOCATION = 0x0200
MSG_TRACK = 0x0600
MSG_QUERY_RESPONSE = 0x0104
MSG_BATCH_LOCATION = 0x0704

# Bit positions in the state word.
STATE_BITS = {
    "acc": 0, "located": 1, "south": 2, "west": 3, "not_operating": 4,
    "encrypted": 5, "oil_cut": 10, "circuit_cut": 11, "door_locked": 12,
}

# Bit positions in the alarm word.
ALARM_BITS = {
    "emergency": 0, "overspeed": 1, "fatigue": 2, "early_warning": 3, "gnss_fault": 4,
    "gnss_antenna": 5, "gnss_short": 6, "undervoltage": 7, "power_down": 8, "lcd_fault": 9,
    "tts_fault": 10, "camera_fault": 11, "sharp_turn": 15, "hard_brake": 17,
    "driving_timeout": 18, "parking_timeout": 19, "area_in_out": 20, "route_in_out": 21,
    "travel_time": 22, "route_deviation": 23, "vss_fault": 24, "oil_fault": 25,
    "stolen": 26, "illegal_ignition": 28, "illegal_move": 29,
}

TLV_MILEAGE = 0x01
TLV_FUEL = 0x02
BODY_FIXED_BYTES = 28
LONG_HEX_DIGITS = 16


def _hex_at(text: Column, byte: Column | int, n_bytes: Column | int) -> Column:
    pos = F.lit(byte) if isinstance(byte, int) else byte
    length = F.lit(n_bytes) if isinstance(n_bytes, int) else n_bytes
    return text.substr(pos * 2 + 1, length * 2)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(text: Column) -> Column:
    """Hex text to bigint; null when empty or wider than a long."""
    significant = F.regexp_replace(text, "^0+", "")
    fits = (F.length(text) > 0) & (F.length(significant) <= LONG_HEX_DIGITS)
    return F.conv(F.when(fits, F.concat(F.lit("0"), significant)), 16, 10).try_cast("long")


def _word(text: Column, byte: int, n_bytes: int) -> Column:
    return F.conv(_hex_at(text, byte, n_bytes), 16, 10).cast("long")


def _bcd(text: Column) -> Column:
    """BCD digits as text, one leading zero dropped; a nibble above 9 prints as two digits."""
    digits = text
    for nibble, shown in zip("abcdef", range(10, 16)):
        digits = F.replace(digits, F.lit(nibble), F.lit(str(shown)))
    return F.regexp_replace(digits, "^0", "")


def xor_checksum(text: Column) -> Column:
    """XOR of all bytes of a hex text. Seven bytes are folded at a time, so that a frame
    costs one number conversion per seven bytes."""
    step = 14
    blocks = F.ceil(F.length(text) / step).cast("int")
    padded = F.concat(text, F.repeat(F.lit("0"), blocks * step - F.length(text)))

    def fold(whole: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.greatest((F.length(whole) / step).cast("int") - 1, F.lit(0))),
            F.lit(0).cast("long"),
            lambda acc, i: acc.bitwiseXOR(
                F.conv(whole.substr(i * step + 1, F.lit(step)), 16, 10).cast("long")
            ),
        )

    def squeeze(folded: Column) -> Column:
        out = folded
        for shift in range(8, 56, 8):
            out = out.bitwiseXOR(F.shiftright(folded, shift))
        return out.bitwiseAND(0xFF).cast("int")

    return _let(_let(padded, fold), squeeze)


def _tlv_items(text: Column) -> Column:
    """Items of a body, see :func:`_walk_items`."""
    return _let(text, _walk_items)


def _walk_items(body: Column) -> Column:
    """Additional items from byte 28 on. The walk stops at the first item that does not fit;
    the length is a signed byte, so 128 and more stop it as well."""
    size = (F.length(body) / 2).cast("int")
    start = F.struct(
        F.lit(BODY_FIXED_BYTES).alias("pos"),
        F.expr("cast(array() as array<struct<id:int,value:string>>)").alias("items"),
    )

    def step(acc: Column, _: Column) -> Column:
        pos, items = acc["pos"], acc["items"]
        length = F.conv(_hex_at(body, pos + 1, 1), 16, 10).cast("int")
        fits = (pos + 2 <= size) & (length < 128) & (pos + 2 + length <= size)
        item = F.struct(
            F.conv(_hex_at(body, pos, 1), 16, 10).cast("int").alias("id"),
            _hex_at(body, pos + 2, length).alias("value"),
        )
        return F.when(
            fits,
            F.struct((pos + 2 + length).alias("pos"), F.array_append(items, item).alias("items")),
        ).otherwise(F.struct((size + 1).alias("pos"), items.alias("items")))

    steps = F.greatest(((size - BODY_FIXED_BYTES) / 2).cast("int"), F.lit(0))
    walk = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(
        F.expr("cast(array() as array<int>)")
    )
    return F.aggregate(walk, start, step)["items"]


def _hex_once(df: DataFrame, frame_col: str) -> DataFrame:
    """Adds ``_f``: the frame as lower-case hex (null if it is none), and whether it is empty.

    The column comes out of a generator, which filters on what is read from it are not pushed through: whatever the frame
    is computed from is evaluated once, and everything below reads a stored value."""
    frame = F.col(frame_col)
    raw = F.lower(frame)
    hexa = F.when((F.length(raw) % 2 == 0) & raw.rlike("^[0-9a-f]+$"), raw)
    empty = frame.isNull() | (frame == "")
    return df.select("*", F.explode(F.array(F.struct(hexa.alias("hex"), empty.alias("empty")))).alias("_f"))


def _reject_reason(hexa: Column, empty: Column) -> Column:
    """Why a frame cannot be decoded, from its lengths alone."""
    size = F.length(hexa) / 2
    props = _word(hexa, 2, 2)
    start = F.when(props.bitwiseAND(0x2000) > 0, 16).otherwise(12)
    body = props.bitwiseAND(0x3FF)
    return (
        F.when(empty, "empty")
        .when(hexa.isNull(), "not_hex")
        .when(size < 12, "short_header")
        .when(start + body > size, "short_frame")
        .when(body < BODY_FIXED_BYTES, "short_body")
    )


def parse_frames(df: DataFrame, frame_col: str = "frame") -> DataFrame:
    """Adds ``header``, ``body`` (hex), ``checksum``, ``checksum_ok`` and ``reject_reason``
    (null for a frame that decodes). The checksum is reported, not enforced."""
    df = _hex_once(df, frame_col)
    hexa = F.col("_f.hex")
    long_enough = F.length(hexa) >= 24
    df = df.withColumn("_props", F.when(long_enough, _word(hexa, 2, 2)))
    props = F.col("_props")
    sub = props.bitwiseAND(0x2000) > 0
    has_sub = sub & (F.length(hexa) >= 32)
    header = F.when(
        long_enough,
        F.struct(
            _word(hexa, 0, 2).cast("int").alias("msg_id"),
            props.bitwiseAND(0x3FF).cast("int").alias("body_length"),
            F.shiftright(props.bitwiseAND(0x1C00), 10).cast("int").alias("encryption"),
            sub.alias("has_sub_package"),
            F.shiftright(props.bitwiseAND(0xC000), 14).cast("int").alias("reserved"),
            _bcd(_hex_at(hexa, 4, 6)).alias("terminal_phone"),
            _word(hexa, 10, 2).cast("int").alias("flow_id"),
            F.when(has_sub, _word(hexa, 12, 2)).cast("int").alias("sub_package_total"),
            F.when(has_sub, _word(hexa, 14, 2)).cast("int").alias("sub_package_seq"),
        ),
    )
    start = F.when(sub, F.lit(16)).otherwise(F.lit(12))
    body_length = props.bitwiseAND(0x3FF).cast("int")
    whole = (start + body_length) * 2 <= F.length(hexa)
    df = df.withColumns(
        {
            "header": header,
            "body": F.when(whole, _hex_at(hexa, start, body_length)),
            "checksum": F.when(
                long_enough, F.conv(F.right(hexa, F.lit(2)), 16, 10).cast("int")
            ),
            "_sum": F.when(
                long_enough, xor_checksum(hexa.substr(F.lit(1), F.length(hexa) - 2))
            ),
        }
    )
    return df.withColumns(
        {
            "checksum_ok": F.col("checksum") == F.col("_sum"),
            "reject_reason": _reject_reason(hexa, F.col("_f.empty")),
        }
    ).drop("_f", "_props", "_sum")


def state_bits(word: Column) -> dict[str, Column]:
    return {name: F.getbit(word, F.lit(bit)).cast("int") for name, bit in STATE_BITS.items()}


def alarm_bits(word: Column) -> dict[str, Column]:
    return {name: F.getbit(word, F.lit(bit)).cast("int") for name, bit in ALARM_BITS.items()}


def tlv_map(items: Column) -> Column:
    """Items as a map id -> hex payload; the last of equal ids wins."""
    def keep_last(found: Column) -> Column:
        tail = F.greatest(F.size(found), F.lit(1))
        return F.filter(
            found, lambda x, i: ~F.exists(F.slice(found, i + 2, tail), lambda y: y["id"] == x["id"])
        )

    return F.map_from_entries(_let(items, keep_last))


def location_fields(parsed: DataFrame) -> DataFrame:
    """Body of decodable frames: words, TLV items and the position columns."""
    good = parsed.where(F.col("reject_reason").isNull())
    body = F.col("body")
    df = good.withColumns(
        {
            "alarm_word": _word(body, 0, 4),
            "state_word": _word(body, 4, 4),
            "altitude": _word(body, 16, 2).cast("int"),
            "tlv": tlv_map(_tlv_items(body)),
        }
    )
    mileage = _let(
        _let(F.try_element_at("tlv", F.lit(TLV_MILEAGE)), _number),
        lambda v: F.when(v.isNotNull(), F.format_string("%.2f", v / 10.0)).otherwise("0"),
    )
    fuel = _let(
        F.try_element_at("tlv", F.lit(TLV_FUEL)),
        lambda v: F.when(v.isNotNull(), F.coalesce((_number(v) / 10).cast("string"), F.lit(""))),
    )
    state = state_bits(F.col("state_word"))
    alarm = alarm_bits(F.col("alarm_word"))
    ts = F.try_to_timestamp(
        F.concat(F.lit("20"), _hex_at(body, 22, 6)), F.lit("yyyyMMddHHmmss")
    ).cast("timestamp_ntz")
    return df.withColumns(
        {
            "devid": F.col("header.terminal_phone"),
            "time": F.date_format(ts, timefn.TIME_FORMAT),
            "lat": _word(body, 8, 4) / 1e6,
            "lng": _word(body, 12, 4) / 1e6,
            "speed": _word(body, 18, 2) / 10.0,
            "pos": _word(body, 20, 2).cast("int"),
            "gpsflag": state["located"],
            "accflag": state["acc"],
            "auxiliaryflag": F.lit(0),
            "gpsdistance": mileage,
            "mainoilper": fuel,
            "sharpturn": alarm["sharp_turn"],
            "brake": alarm["hard_brake"],
        }
    ).withColumn("point", F.concat_ws(",", F.col("lat").cast("string"), F.col("lng").cast("string")))


def decode_frames(
    df: DataFrame, frame_col: str = "frame", mode: str = "PERMISSIVE", msg_id: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(positions, rejected). ``mode='FAILFAST'`` stops the job at the first bad frame."""
    parsed = parse_frames(df, frame_col)
    if mode == "FAILFAST":
        bad = F.concat(F.lit("undecodable frame: "), F.col("reject_reason"))
        parsed = parsed.withColumn(
            "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.raise_error(bad))
        )
    good = location_fields(parsed)
    if msg_id is not None:
        good = good.where(F.col("header.msg_id") == msg_id)
    rejected = parsed.where(F.col("reject_reason").isNotNull())
    return good, rejected
