"""Scalar rules over words and texts, as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values that results depend on.
MIN_WORD_MS = 40
CHARS_PER_SECOND = 14
TOLERANCE = 2.5
RATE_FLOOR_MS = 1500
DIVERGENCE_MS = 1500
SEAM_MS = 250
DEGENERATE_MS = 16
SPEAKER_COLOURS = 8


def half_up(x: Column) -> Column:
    """Nearest integer, halves upwards (also below zero)."""
    return F.floor(x + F.lit(0.5)).cast("long")


@dataclass(frozen=True)
class Counted:
    """Stands for a text in the rules below where its characters are counted already."""

    chars: Column


def n_chars(text: Column | Counted) -> Column:
    """Characters but white space, at least 1."""
    if isinstance(text, Counted):
        return text.chars
    return F.greatest(F.length(F.regexp_replace(text, r"(?U)\s+", "")), F.lit(1))


def typical_word_ms(text: Column) -> Column:
    return n_chars(text) * F.lit(1000.0) / F.lit(CHARS_PER_SECOND)


def max_word_ms(text: Column) -> Column:
    return F.greatest(F.lit(RATE_FLOOR_MS).cast("long"), half_up(typical_word_ms(text) * TOLERANCE))


def credible(text: Column, dur: Column) -> Column:
    return F.coalesce((dur >= MIN_WORD_MS) & (dur >= typical_word_ms(text) / TOLERANCE), F.lit(False))


def evidence_ceiling(text: Column, dur: Column) -> Column:
    return F.when(credible(text, dur), F.least(max_word_ms(text), half_up(dur * TOLERANCE + MIN_WORD_MS))).otherwise(max_word_ms(text))


def near_zero_corroborated(dur: Column) -> Column:
    return F.coalesce((dur > 0) & (dur <= MIN_WORD_MS * TOLERANCE), F.lit(False))


def plausible(text: Column, start: Column, end: Column, dur: Column | None = None) -> Column:
    ceiling = max_word_ms(text) if dur is None else evidence_ceiling(text, dur)
    return F.coalesce((end - start >= MIN_WORD_MS) & (end - start <= ceiling), F.lit(False))


def timecode(ms: Column, fps: int = 25) -> Column:
    """HH:MM:SS;FF"""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    s = F.floor(ms / 1000)
    frame = F.floor((ms % 1000) / (1000 / fps))
    return F.concat(two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60), F.lit(";"), two(frame))


def sentence_end(text: Column) -> Column:
    return text.rlike(r"""[.!?…。！？]["'”’)\]]*\z""")


def punctuation_only(text: Column) -> Column:
    return F.coalesce(~text.rlike(r"[\p{L}\p{N}]"), F.lit(True))


def join_words(words: Column) -> Column:
    kept = F.filter(F.transform(words, F.trim), lambda w: w != "")
    text = F.regexp_replace(F.array_join(kept, " "), r"\s+([,.;:!?])", "$1")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def confidence_norm(x: Column) -> Column:
    """0..1; values above 1 are percentages; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(x > 1, x / 100).otherwise(x))))


def fnv1a32(text: Column) -> Column:
    """Eight hexadecimal digits; each character counts by its code point."""
    h = F.aggregate(F.transform(F.split(text, ""), F.ascii), F.lit(2166136261).cast("long"), lambda a, c: (a.bitwiseXOR(c.cast("long")) * 16777619).bitwiseAND(F.lit(4294967295)))
    return F.lower(F.lpad(F.hex(F.when(text == "", F.lit(2166136261).cast("long")).otherwise(h)), 8, "0"))


def slug(label: Column) -> Column:
    """Every character but ASCII letters and digits becomes `_`; 40 characters."""
    named = F.when(F.coalesce(label, F.lit("")) == "", F.lit("speaker")).otherwise(label)
    return F.substring(F.regexp_replace(named, "[^A-Za-z0-9]", "_"), 1, 40)


def safe_name(name: Column) -> Column:
    """A file name without path characters and leading dots, of 180 characters at most."""
    clean = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), r"""[\\/:*?"<>|\x00-\x1f]""", "_"), r"^\.+", ""), 1, 180)
    return F.when(clean == "", F.lit("segment.wav")).otherwise(clean)


def speaker_label(cluster: Column, index: Column) -> Column:
    """`Speaker n`: the cluster's trailing number plus one, else the place plus one."""
    digits = F.regexp_extract(F.coalesce(cluster, F.lit("")), r"(\d+)$", 1)
    return F.concat(F.lit("Speaker "), F.when(digits != "", (digits.try_cast("decimal(38,0)") + 1).cast("string")).otherwise((index + 1).cast("string")))


def provider_speaker_label(ref: Column, index: Column) -> Column:
    """`speaker_n` by its number plus one, any other reference as it is."""
    ref = F.coalesce(ref, F.lit(""))
    digits = F.regexp_extract(ref, r"(?i)^speaker[_\s]?(\d+)$", 1)
    named = F.when(ref != "", ref).otherwise((index + 1).cast("string"))
    return F.concat(F.lit("Speaker "), F.when(digits != "", (digits.try_cast("decimal(38,0)") + 1).cast("string")).otherwise(named))


def job_key(kind: Column | str, *ids: Column) -> Column:
    """Deterministic job id: the kind and its ids; a kind without ids is a singleton."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat_ws("-", kind, *[i.cast("string") for i in ids]) if ids else F.concat(kind, F.lit("-singleton"))


def count_words(text: Column, words: Column | None = None) -> Column:
    """Size of the word list where there is one, else words of the text."""
    said = F.size(F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != ""))
    return (said if words is None else F.when(words.isNotNull(), F.size(words)).otherwise(said)).cast("long")


def failure_class(message: Column, status: Column | None = None) -> Column:
    """Class of a failed call by its message and, where known, its HTTP status:
    stand_down (409 with `"stand_down": true` at the top of a JSON body), then
    rate_limited, gateway_timeout, auth_rejected, transient, none (no message), terminal."""
    said = F.coalesce(message, F.lit(""))
    code = F.regexp_extract(said, r"(?i)\bHTTP (\d{3})\b", 1)
    code = code if status is None else F.coalesce(status.cast("string"), code)
    body = F.when(said.startswith("{"), said).otherwise(F.regexp_extract(said, r"(?s)(\{.*\})", 1))
    stands = F.coalesce(F.from_json(body, "stand_down boolean")["stand_down"], F.lit(False))
    return (
        F.when((code == "409") & stands, "stand_down").when((code == "429") | said.rlike("(?i)rate limit"), "rate_limited")
        .when(code.isin("502", "503", "504", "524"), "gateway_timeout").when((code == "403") & said.rlike("auth_required|(?i)This app is private"), "auth_rejected")
        .when(said.rlike("(?i)timeout|timed out|ECONNRESET|fetch failed|network|socket"), "transient").when(said == "", "none").otherwise("terminal")
    )


def backoff_ms(base: Column, factor: float, attempt: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), base * F.pow(F.lit(factor), attempt - 1)).cast("long")


def jittered_backoff_ms(attempt: Column, seed: Column) -> Column:
    """Between 500 ms and min(20 s, 1 s doubled per attempt), chosen by the seed's hash."""
    ceiling = F.least(F.lit(20_000.0), F.lit(1000.0) * F.pow(F.lit(2.0), attempt - 1))
    share = F.conv(F.substring(F.sha2(seed.cast("string"), 256), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return F.greatest(F.lit(500), F.floor(share * ceiling)).cast("long")
