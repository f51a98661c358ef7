"""Levels, percentages and numbers for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls

LARGE_FILE = 95 * 1024 * 1024
CHUNK = 20_000_000
# What exit codes mean.
EXIT_HINTS = {2: "rejected its arguments", 124: "timed out", 130: "SIGINT (Ctrl-C)", 134: "SIGABRT", 137: "SIGKILL — likely OOM", 139: "SIGSEGV", 143: "SIGTERM"}


def level(unlimited: Column) -> Column:
    return F.when(unlimited >= 5000, "very high").when(unlimited >= 1000, "high").when(unlimited >= 100, "moderate").when(unlimited > 0, "low").otherwise("very low")


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, halves to even; 0 where either is 0."""
    return F.when((part > 0) & (whole > 0), F.bround(part / whole * 100, 0)).otherwise(0).cast("int")


def human_bytes(n: Column) -> Column:
    """One decimal in the largest unit of 1,024 that leaves 1 or more."""
    out, size = F.format_string("%,.1f PB", n / 1024.0**5), 1024.0**5
    for unit in ("TB", "GB", "MB", "KB", "B"):
        out = F.when(n < size, F.format_string(f"%,.1f {unit}", n / (size / 1024))).otherwise(out)
        size /= 1024
    return out


def progress(done: Column, total: Column) -> Column:
    share = F.when(total > 0, F.format_string(", ~%.1f%%", done / total * 100)).otherwise("")
    return F.concat(F.format_string("%,d / %,d files", done, total), share)


def upload_chunk(size: Column, exists: Column) -> Column:
    """Bytes a chunk; 0 sends a file that exists at once, unless it is too large for that."""
    return F.when(exists & (size <= LARGE_FILE), 0).otherwise(CHUNK)


def exit_text(code: Column) -> Column:
    """What an exit code says; empty for success."""
    hint = F.lit(None).cast("string")
    for n, words in EXIT_HINTS.items():
        hint = F.when(code == n, words).otherwise(hint)
    hint = F.coalesce(hint, F.when(code > 128, F.concat(F.lit("signal "), (code - 128).cast("string"))))
    return F.when(code == 0, "").otherwise(F.concat(F.lit(" (exit "), code.cast("string"), F.coalesce(F.concat(F.lit(" — "), hint), F.lit("")), F.lit(")")))


def readiness_sentence(name: Column, unlimited: Column, old_other: Column, total: Column, kind: str = "domain", aside: Column | None = None, hub: Column | None = None) -> Column:
    """What a list says of a domain or an institution.  aside: an example institution of a domain, or an institution's domain."""
    nothing = F.lit(None).cast("string")
    aside, hub = nothing if aside is None else aside, nothing if hub is None else hub
    search = lambda c: urls.search_url(c, hub)
    if kind == "domain":
        shown = F.concat(F.lit("'[**"), name, F.lit("**](https://"), name, F.lit(")'"))
        extra = F.when((aside != "") & (hub != ""), F.concat(F.lit(" *(e.g. '["), aside, F.lit("]("), search(aside), F.lit(")')*")))
    else:
        safe = F.regexp_replace(name, r"([|\[\]])", r"\\$1")
        shown = F.when(hub != "", F.concat(F.lit("'[**"), safe, F.lit("**]("), search(name), F.lit(")'"))).otherwise(F.concat(F.lit("'**"), safe, F.lit("**'")))
        extra = F.when(aside != "", F.concat(F.lit(" *(["), aside, F.lit("](https://"), aside, F.lit("))*")))
    subject = F.concat(shown, F.coalesce(extra, F.lit("")))
    items = lambda n: F.when(n == 1, "item").otherwise("items")
    where = "across all collections hosted on this domain" if kind == "domain" else "already"
    review = " over 120 years old in other rights categories that could become eligible with rights review"
    more = F.when(old_other > 0, F.concat(F.lit(", and **"), F.format_string("%,d", old_other), F.lit("** additional "), items(old_other), F.lit(review))).otherwise("")
    counted = F.concat(
        subject, F.lit(" has a **"), level(unlimited), F.lit("** readiness score because it has **"), F.format_string("%,d", unlimited), F.lit("** eligible public domain "), items(unlimited), F.lit(" (**"),
        percent(unlimited, total).cast("string"), F.lit("%** of **"), F.format_string("%,d", total), F.lit(f"** total items) {where} in CONTENTdm or providing a media location"), more, F.lit("."),
    )
    none = F.concat(subject, F.lit(" has a **very low** readiness score with no public domain items"))
    old = F.concat(none, F.lit(", but has **"), F.format_string("%,d", old_other), F.lit("** "), items(old_other), F.lit(review + "."))
    return F.when(unlimited > 0, counted).when(old_other > 0, old).otherwise(F.concat(none, F.lit(" and no items dated over 120 years old.")))


# How files of a type begin (hexadecimal), at which byte.
BEGINNINGS = (
    ("image/jpeg", 0, "FFD8FF"), ("image/png", 0, "89504E470D0A1A0A"), ("image/gif", 0, "47494638"), ("image/tiff", 0, "49492A00"), ("image/tiff", 0, "4D4D002A"), ("application/pdf", 0, "255044462D"), ("image/webp", 8, "57454250"),
    ("video/quicktime", 4, "667479707174"), ("video/mp4", 4, "66747970"), ("video/x-msvideo", 8, "415649"), ("audio/x-wav", 8, "57415645"), ("audio/mpeg", 0, "494433"), ("audio/ogg", 0, "4F676753"), ("application/zip", 0, "504B0304"),
    ("application/xml", 0, "3C3F786D6C"), ("text/html", 0, "3C21444F4354595045"), ("text/html", 0, "3C68746D6C"),
)


def sniffed_type(content: Column) -> Column:
    """The type of a file by how it begins; "application/octet-stream" where that says nothing."""
    start = F.hex(F.substring(content, 1, 32))
    out = F.lit("application/octet-stream")
    for kind, at, begins in reversed(BEGINNINGS):
        out = F.when(F.substring(start, 2 * at + 1, len(begins)) == begins, kind).otherwise(out)
    return out
