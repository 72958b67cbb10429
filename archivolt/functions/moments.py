"""Moments from the date notations web servers and sitemaps write."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_moment(micros: Column) -> Column:
    """ISO-8601 in UTC with milliseconds, whatever the session's zone."""
    day, rest = F.floor(micros / F.lit(86_400_000_000)), F.pmod(micros, F.lit(86_400_000_000))
    clock = F.format_string("T%02d:%02d:%02d.%03dZ", F.floor(rest / 3_600_000_000), F.floor(rest / 60_000_000) % 60, F.floor(rest / 1_000_000) % 60, F.floor(rest / 1000) % 1000)
    return F.when(micros.isNotNull(), F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), clock))


def moment_micros(text: Column) -> Column:
    """Microseconds since 1970 UTC named by an ISO-8601 or RFC 1123 text, else NULL.

    A bare date is midnight UTC, a date-time without zone is UTC; blank or unreadable text gives NULL.
    """
    t = F.trim(text)
    iso = r"^\d{4}-\d{2}-\d{2}"
    clock = r"[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?"
    whole = (
        F.when(t.rlike(iso + "$"), F.concat(t, F.lit("T00:00:00Z")))
        .when(t.rlike(iso + clock + "$"), F.concat(t, F.lit("Z")))
        .when(t.rlike(iso + clock + r"\s*([Zz]|[+-]\d{2}:?\d{2})$"), F.regexp_replace(F.regexp_replace(t, "[Zz]$", "Z"), r"([+-]\d{2})(\d{2})$", "$1:$2"))
    )
    mail = r"^(?:[A-Za-z]{3,9},? )?(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}) (\d{2}:\d{2}:\d{2})\s*(?:GMT|UTC|Z)?([+-]\d{4})?$"
    zone = F.regexp_extract(t, mail, 5)
    said = F.when(
        t.rlike(mail),
        F.concat_ws(" ", F.regexp_extract(t, mail, 1), F.initcap(F.regexp_extract(t, mail, 2)), F.regexp_extract(t, mail, 3), F.regexp_extract(t, mail, 4), F.when(zone == "", F.lit("+0000")).otherwise(zone)),
    )
    return F.coalesce(
        F.unix_micros(F.try_to_timestamp(whole)),
        F.unix_micros(F.try_to_timestamp(said, F.lit("d MMM yyyy HH:mm:ss Z"))),
    )
