"""Templates in wiki text: a small parser that minds nesting, and what rests on it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as texts

# The two-letter codes of languages (ISO 639-1).
LANGUAGES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id"
    " ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt"
    " qu rm rn ro ru rw sa sc sd se sg sh si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
# Languages by their English names.
LANGUAGE_NAMES = {
    "english": "en", "spanish": "es", "french": "fr", "german": "de", "italian": "it", "portuguese": "pt", "dutch": "nl", "russian": "ru", "polish": "pl", "swedish": "sv", "norwegian": "no",
    "danish": "da", "finnish": "fi", "czech": "cs", "hungarian": "hu", "greek": "el", "turkish": "tr", "arabic": "ar", "hebrew": "he", "chinese": "zh", "japanese": "ja", "korean": "ko",
    "vietnamese": "vi", "thai": "th", "hindi": "hi", "latin": "la", "welsh": "cy", "irish": "ga", "ukrainian": "uk", "romanian": "ro", "bulgarian": "bg", "serbian": "sr", "croatian": "hr",
    "slovak": "sk", "slovenian": "sl", "lithuanian": "lt", "latvian": "lv", "estonian": "et", "icelandic": "is", "catalan": "ca",
}
METADATA = "DPLA metadata"
_OPEN_CLOSE = re.compile(r"\{\{|\}\}|\[\[|\]\]|\||=")

def find_template(text: str, name: str) -> tuple[int, int] | None:
    """Where the first template of that name begins and ends (case of the first letter and underscores don't count)."""
    wanted = name.replace("_", " ").strip().casefold()
    depth, starts = 0, []
    for found in re.finditer(r"\{\{|\}\}", text):
        if found[0] == "{{":
            starts.append(found.start())
            depth += 1
        elif starts:
            start = starts.pop()
            depth -= 1
            head = re.split(r"[|}]", text[start + 2 : found.start()], maxsplit=1)[0]
            if head.replace("_", " ").strip().casefold() == wanted:
                return start, found.end()
    return None


def arguments(body: str) -> list[tuple[str | None, str]]:
    """Names (None for unnamed ones) and values of a template's inner text; pipes and equal signs inside inner templates and
    links stay."""
    parts, depth, last, equals = [], 0, 0, None
    for found in _OPEN_CLOSE.finditer(body):
        if found[0] in ("{{", "[["):
            depth += 1
        elif found[0] in ("}}", "]]"):
            depth = max(0, depth - 1)
        elif depth == 0 and found[0] == "|":
            parts.append((last, equals, found.start()))
            last, equals = found.end(), None
        elif depth == 0 and equals is None:
            equals = found.start()
    parts.append((last, equals, len(body)))
    return [(None, body[start:end].strip()) if at is None else (body[start:at].strip(), body[at + 1 : end].strip()) for start, at, end in parts[1:]]


def parameters(text: str | None, name: str) -> dict[str, str] | None:
    """The parameters of the first template of that name, unnamed ones by number."""
    place = find_template(text or "", name)
    if place is None:
        return None
    out, number = {}, 0
    for key, value in arguments((text or "")[place[0] + 2 : place[1] - 2]):
        number += key is None
        out[str(number) if key is None else key] = value
    return out


def only_templates(text: str, names: tuple[str, ...]) -> bool:
    """Whether a text is templates of these names, one at least, and white space."""
    seen = False
    while text.strip():
        place = min((p for p in (find_template(text, n) for n in names) if p), default=None)
        if place is None or text[: place[0]].strip():
            return False
        text, seen = text[place[1] :], True
    return seen


def template_parameters(text: Column, name: str) -> Column:
    """map of parameters, null where the template is not there; only texts with the name leave the JVM."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def parse(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else parameters(v, name))

    near = F.contains(F.lower(F.translate(text, "_", " ")), F.lit(name.replace("_", " ").lower()))
    return F.when(near, parse(F.when(near, text)))


def unwrap_language(value: Column) -> Column:
    """struct(text, language) of {{xx|text}} or {{xx|1=text}} with a known language; other values are English as they are."""
    shape = r"(?is)^\s*\{\{\s*([a-z]{2})\s*\|\s*(?:1\s*=\s*)?((?:[^{}|=\[\]]|\{\{[^{}]*\}\}|\[\[[^\[\]]*\]\])*?)\s*\}\}\s*$"
    return F.when(value.rlike(shape) & F.lower(F.regexp_extract(value, shape, 1)).isin(*LANGUAGES), F.struct(F.regexp_extract(value, shape, 2).alias("text"), F.lower(F.regexp_extract(value, shape, 1)).alias("language"))).otherwise(
        F.struct(value.alias("text"), F.lit("en").alias("language"))
    )


def institution_of(value: Column) -> Column:
    """The entity of an institution, bare or in its template."""
    bare = F.nullif(F.regexp_extract(value, r"^\s*(Q\d+)\s*$", 1), F.lit(""))
    inner = F.nullif(F.regexp_extract(value, r"(?i)\{\{\s*institution\s*\|[^{}]*?wikidata\s*=\s*(Q\d+)", 1), F.lit(""))
    return F.coalesce(bare, inner)


def split_extra(value: Column, canonical: Column) -> Column:
    """What stands after the first line break or tab of a value that begins with the canonical one; else null."""
    at = F.regexp_instr(value, F.lit(r"[\n\r\t]"))
    return F.when((at > 0) & (texts.folded(F.substr(value, F.lit(1), at - 1)) == texts.folded(canonical)), F.substr(value, at))


def normalize(text: Column, name: str, expected: Column) -> Column:
    """struct(kept, stripped): the template's parameters that differ from the expected ones, and the names of those that
    do not (white space and case at the ends apart)."""
    own = template_parameters(text, name)
    same = lambda k, v: F.coalesce(F.lower(F.trim(F.try_element_at(expected, k))) == F.lower(F.trim(v)), F.lit(False))
    return F.struct(F.map_filter(own, lambda k, v: ~same(k, v)).alias("kept"), F.array_sort(F.map_keys(F.map_filter(own, same))).alias("stripped"))


def has_metadata_template(value: Column) -> Column:
    return template_parameters(value, METADATA).isNotNull()


def file_name(name: Column) -> Column:
    """A file's title without its prefix, underscores as spaces, first letter in upper case."""
    bare = F.regexp_replace(F.trim(name), r"(?i)^file:", "")
    spaced = F.trim(F.regexp_replace(bare, r"[\s_]+", " "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.substr(spaced, F.lit(2)))


def related_files(value: Column) -> Column:
    """Files that "other version" templates name, each once, in order."""
    found = F.regexp_extract_all(value, F.lit(r"(?i)\{\{\s*other[\s_]*version\s*\|([^{}|]+)(?:\|[^{}]*)?\}\}"), 1)
    return F.array_distinct(F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), file_name), lambda x: x != ""))


def institution_in_page(value: Column) -> Column:
    """The entity in a page's first institution template."""
    return F.nullif(F.regexp_extract(value, r"(?is)\{\{\s*institution\b(?:(?!\}\}).)*?\|\s*wikidata\s*=\s*(Q\d+)", 1), F.lit(""))


def hub_in_page(value: Column) -> Column:
    """The hub's entity in a page's first template of the aggregator."""
    return F.nullif(F.regexp_extract(value, r"(?is)\{\{\s*DPLA\b(?:(?!\}\}).)*?\|\s*hub\s*=\s*(Q\d+)", 1), F.lit(""))


def language_wrapper(value: Column) -> Column:
    """The code of a value that is one template of a language with one unnamed argument; null for all else."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(value), r"(?is)^\{\{\s*([a-z]{2,3}(?:-[a-z0-9]+)*)\s*\|(?:[^{}|=]|\{\{[^{}]*\}\})*\}\}$", 1)), F.lit(""))


def language_codes(names: Column) -> Column:
    """Codes of languages by their English names, always with English; unknown names are left out."""
    table = F.create_map(*[F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair])
    found = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.try_element_at(table, F.lower(F.trim(n))))
    return F.array_sort(F.array_union(F.array(F.lit("en")), F.array_compact(found)))


#: Parameters of the metadata template, in the order in which a page has them.
PARAMETERS = ("creator", "title", "description", "date", "permission", "hub", "institution", "url", "dpla_id", "local_id")


def metadata_page(values: dict[str, Column]) -> Column:
    """The text of a file's page: its metadata template with a row for each of PARAMETERS; that of the creator only if there
    is one."""
    rows = [F.concat(F.lit(f"\n| {name} = "), F.coalesce(values[name], F.lit(""))) for name in PARAMETERS]
    rows[0] = F.when(F.coalesce(values["creator"], F.lit("")) != "", rows[0]).otherwise("")
    return F.concat(F.lit("== {{int:filedesc}} ==\n\n{{" + METADATA), *rows, F.lit("\n}}"))


def canonical_page(value: Column) -> Column:
    """A page with its metadata template in the usual shape: a parameter a line, without white space around names and values."""

    @F.pandas_udf(T.StringType())
    def shaped(values: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            place = find_template(text or "", METADATA)
            if place is None:
                return text
            own, number, lines = arguments(text[place[0] + 2 : place[1] - 2]), 0, []
            for key, content in own:
                number += key is None
                lines.append(f"\n| {number if key is None else key} = {content}")
            whole = text[: place[0]] + "{{" + METADATA + "".join(lines) + ("\n" if lines else "") + "}}" + text[place[1] :]
            return re.sub(r"(==\s*\{\{int:filedesc\}\}\s*==)\s*\n\s*(?=\{\{" + METADATA + ")", r"\1\n\n", whole)

        return values.map(one)

    near = F.contains(F.lower(F.translate(value, "_", " ")), F.lit(METADATA.lower()))
    return F.when(near, shaped(F.when(near, value))).otherwise(value)


# Fixed patterns: what of a page stays when it is written anew, by group; assessments stand under a heading of their own.
ASSESSMENTS = r"(?i)\{\{\s*(?:Media of the day|Picture of the day|Featured picture|Quality image|Valued image|Assessments)\s*(?:\|[^{}]*)?\}\}"
LICENSES, EXTRACTED, CATEGORIES = r"\{\{PD-USGov(?:-[A-Za-z0-9_-]+)?(?:\|[^{}]*)?\}\}", r"(?i)\{\{Image extracted\|[^{}]*\}\}", r"\[\[Category:[^\]\n]+\]\]"


def merged_page(old: Column, new: Column) -> Column:
    """The new text of a page with what must stay of the old: assessments, licenses, parent images and categories, each once
    and in order, unless the new text has them."""
    kept = lambda pattern: F.array_except(F.array_distinct(F.regexp_extract_all(old, F.lit(pattern), 0)), F.regexp_extract_all(bare, F.lit(pattern), 0))
    bare = texts.rstrip(new)
    lines = lambda items, head: F.when(F.size(items) > 0, F.concat(F.lit(head), F.array_join(items, "\n"))).otherwise("")
    ends = F.substring_index(bare, "\n", -1).rlike(r"^\s*" + CATEGORIES)
    categories = kept(CATEGORIES)
    last = F.when(ends, lines(categories, "\n")).otherwise(lines(categories, "\n\n"))
    return F.concat(bare, lines(kept(ASSESSMENTS), "\n\n=={{Assessment}}==\n"), lines(kept(LICENSES), "\n\n"), lines(kept(EXTRACTED), "\n\n"), last, F.lit("\n"))


#: Bytes of a comment, and those that a move adds to it beside names.
COMMENT_BYTES, MOVE_BYTES = 500, 36


def move_reason(old: Column, new: Column, item: Column, user: Column) -> Column:
    """The longest wording of why a file is moved that fits a comment; the shortest where none does."""
    lead = "Title drift correction"
    linked = F.concat(F.lit("[[dpla:"), item, F.lit("|"), item, F.lit("]]"))
    said = lambda middle, what: F.concat(F.lit(f"{lead}{middle} ("), what, F.lit(")"))
    longer = ": updating to current DPLA title"
    words = F.array(said(longer, F.concat(F.lit("DPLA ID "), linked)), said(longer, F.concat(F.lit("DPLA ID "), item)), said("", F.concat(F.lit("DPLA ID "), item)), said("", item), F.lit(lead))
    room = COMMENT_BYTES - MOVE_BYTES - F.octet_length(user) - F.octet_length(old) - F.octet_length(new)
    return F.coalesce(F.try_element_at(F.filter(words, lambda w: F.octet_length(w) <= room), F.lit(1)), F.lit(lead))
