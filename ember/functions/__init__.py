"""Scalar column expressions.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Age buckets: right-closed upper bounds and their labels, in order; ages
# above the last bound get the open label.
AGE_BOUNDS = (18, 35, 50)
AGE_LABELS = ("0-18", "18-35", "35-50", "50+")
# Gender codes read from the grouped list; other codes are ignored.
GENDER_CODES = ("M", "F")
# Review scores that survive cleaning (compared as text).
VALID_SCORES = ("1", "2", "3", "4", "5")
# Frame output file name: camera id, frame number padded to six digits.
FRAME_FILENAME_FORMAT = "%s_%06d.png"
# ---------------------------------------------------------------------------

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def field(line: Column | str, index: int, sep: str = ",") -> Column:
    """Field ``index`` of a delimited line; NULL when the line is short.

    ``split`` takes a regular expression, so the separator is escaped (a bare
    pipe would split every character); ``get`` returns NULL past the end where
    ``[i]`` raises under ANSI.
    """
    return F.get(F.split(_c(line), re.escape(sep)), index)


def split_list(text: Column | str, sep: str) -> Column:
    """Split a list-valued text field on a literal separator."""
    return F.split(_c(text), re.escape(sep))


def age_group(age: Column | str) -> Column:
    """Right-closed age bucket label (``<=18``, ``<=35``, ``<=50``, else)."""
    age = _c(age)
    expr = None
    for bound, label in zip(AGE_BOUNDS, AGE_LABELS):
        expr = F.when(age <= bound, label) if expr is None else expr.when(age <= bound, label)
    return expr.when(age.isNotNull(), AGE_LABELS[-1])


def two_decimals(x: Column | str) -> Column:
    """Text with two decimals, rounding the exact binary value (0.125 -> 0.12).

    ``format_number`` with a pattern uses Java's DecimalFormat, which rounds
    half-even on the exact value, as Python's ``f"{x:.2f}"`` does, and has
    no thousands grouping with the ``0.00`` pattern.
    """
    return F.call_function("format_number", _c(x), F.lit("0.00"))


def or_na(text: Column | str) -> Column:
    """Missing value rendered as ``NA``."""
    return F.coalesce(_c(text), F.lit("NA"))


def epoch_seconds_to_year(seconds: Column | str) -> Column:
    """Calendar year of epoch seconds in the session time zone, as BIGINT."""
    return F.year(F.timestamp_seconds(_c(seconds))).cast("bigint")


def epoch_millis(ts: Column | str, ntz: bool = True) -> Column:
    """Whole milliseconds since the epoch (truncated).

    For ``TIMESTAMP_NTZ`` the wall-clock value is taken as UTC, independent of
    the session time zone; for ``TIMESTAMP`` the instant is used.
    """
    if ntz:
        return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(ts))
    return F.unix_millis(_c(ts))


def now_millis() -> Column:
    """The query's current time as epoch milliseconds (one value per query)."""
    return F.unix_millis(F.current_timestamp())


def iso_time(ts: Column | str | None = None) -> Column:
    """ISO-8601 local time text with microseconds (``now`` by default)."""
    return F.date_format(F.current_timestamp() if ts is None else _c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparsable text gives NULL instead of failing."""
    if fmt is None:
        return F.try_to_timestamp(_c(text))
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def to_int(text: Column | str) -> Column:
    """Text -> int, NULL when not an integer (ANSI-safe)."""
    return _c(text).try_cast("int")


def money(x: Column | str) -> Column:
    """Money as DECIMAL(18,2) so sums do not depend on shuffle order."""
    return _c(x).cast("decimal(18,2)")


def frame_filename(camera_id: Column | str, frame_number: Column | str) -> Column:
    """``{camera}_{frame:06d}.png``; seven-digit numbers are kept whole."""
    return F.format_string(FRAME_FILENAME_FORMAT, _c(camera_id), _c(frame_number))


def b64encode(data: Column | str) -> Column:
    """Standard base64 text without line breaks (whatever the chunk setting)."""
    return F.replace(F.base64(_c(data)), F.lit("\r\n"), F.lit(""))


def b64encode_text(text: Column | str) -> Column:
    return b64encode(F.encode(_c(text), "UTF-8"))


def b64decode(text: Column | str) -> Column:
    """Lenient decode, as the consumer does; NULL where ``is_valid_base64`` says no, never an error.

    Foreign characters are skipped; data ends at the padding.
    """
    raw = _c(text)
    data = F.regexp_extract(F.regexp_replace(raw, f"[^{_B64_ALPHABET}=]", ""), "^=*([^=]*)", 1)
    strict = F.try_to_binary(raw, F.lit("base64"))
    return F.when(is_valid_base64(raw), F.coalesce(strict, F.try_to_binary(data, F.lit("base64"))))


_B64_ALPHABET = "A-Za-z0-9+/"
_B64_SIMPLE = f"^[{_B64_ALPHABET}]*=*\\z"


def is_valid_base64(text: Column | str) -> Column:
    """True when a lenient base64 decoder (Python's default) accepts the text.

    Characters outside the alphabet are skipped.  Decoding ends at the first
    ``=`` that completes a 4-character group (later text is ignored); a ``=``
    before the second character of a group is skipped; otherwise the data
    must end on a group boundary.  Canonical text is accepted by a JVM
    decode/encode round trip; the shape "data, then trailing ``=``" is decided from two
    lengths; any other text runs the decoder's state machine over its
    characters with ``aggregate`` (JVM-side).
    """
    raw = _c(text)
    clean = F.when(raw.rlike(_B64_SIMPLE), raw).otherwise(
        F.regexp_replace(raw, f"[^{_B64_ALPHABET}=]", ""))
    n_data = F.length(F.translate(clean, "=", ""))
    n_pad = F.length(clean) - n_data
    rem = n_data % 4
    simple_ok = (rem == 0) | ((rem == 2) & (n_pad >= 2)) | ((rem == 3) & (n_pad >= 1))

    init = F.struct(F.lit(0).alias("q"), F.lit(0).alias("p"), F.lit(False).alias("done"))

    def step(acc, ch):
        q, p, done = acc["q"], acc["p"], acc["done"]
        pad = ch == "="
        counts = pad & (q >= 2)
        completes = counts & (q + p + 1 >= 4)
        return F.struct(
            F.when(done | pad, q).otherwise((q + 1) % 4).alias("q"),
            F.when(done, p).when(counts, p + 1).when(pad, p).otherwise(0).alias("p"),
            (done | completes).alias("done"),
        )

    machine = F.aggregate(F.split(clean, ""), init, step, lambda a: a["done"] | (a["q"] == 0))
    # Canonical base64 (the normal case) re-encodes to itself: settled by one
    # decode and one encode in the JVM; only other text pays for the regex.
    strict = b64encode(F.try_to_binary(raw, F.lit("base64"))) == raw
    return (F.when(raw.isNull(), F.lit(False)).when(strict, F.lit(True))
            .when(clean.rlike(_B64_SIMPLE), simple_ok).otherwise(machine))


def octets(text: Column | str) -> Column:
    """UTF-8 byte length of a text."""
    return F.octet_length(F.encode(_c(text), "UTF-8"))
