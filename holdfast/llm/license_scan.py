r"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

DataFrame functions only.  Templates are sentences that put a file under a licence, openings of long licences, and whole short
licences.  Common words do not count.  Term weights: count times log(1 + templates / templates with the word) over the
templates, which are fixed and few; words that no template has count in a text's length with the largest of these weights.

Every template has anchor words, those that fewest licences have, as many as it needs so that a text without any of them has a lower cosine than is
asked for (what is left of its vector is too short).  Texts without an anchor word are passed over.  In the others a template is
compared with windows of its own length, placed so that an anchor word stands where the template has it: a header anywhere in
the text, an opening in its first words.  The whole text, however long, is compared with every template as well.  A file with
a header has that licence.  A file that is as a whole like a template, or has an opening, is a licence file: it gives its
licence to its directory, and every file without a licence of its own takes that of its nearest ancestor directory that has
one, found by joining the prefixes of its path.

Null texts have no licence of their own; null paths neither inherit nor give; equal paths are separate rows; ties go to the
first licence by name; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, license_texts

#: Least cosine of a header or opening, and of a whole file.
HEADER_COSINE, FILE_COSINE = 0.85, 0.8
#: Words of a text in which an opening begins.
OPENING_WORDS = 40
# Common words, which are no terms.
COMMON = (
    "a about all also an and any are as at be been being but by can could day did do down each either even find first for from get go had has have he her him his how i if in into is it its like long look made make many"
    " may more most must my name neither new no nor not now of on one only or other our out over part said she so some such than that the their them then there these they this time to two under up use was way we were"
    " what when which who will with work would you your"
).split()
#: Words of ordinary texts: they are anchors only where rarer ones do not suffice (which words are anchors changes no result).
ORDINARY = (
    "2 29 2.0 4.0 2007 act appear applications author benefit business caused charge compile compiled conditions connection contributors copies damage deal definitions derived distribute distributed domain except fee files"
    " forms foundation future general goods governed however included intend interest international interruption january kind large law laws library limitation list materials means merge met names november option original"
    " performance permit person persons possibility present prior procurement products program project promote publish published recognize regard required restriction restrictions resulting rights sell services specific"
    " strict substantial substitute theory used version versions whom written"
).split()
_WORD = r"[a-z0-9][a-z0-9.\-]*[a-z0-9]|[a-z0-9]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> list[str]:
    return [w for w in re.findall(_WORD, text.lower()) if w not in COMMON]


def standard() -> list[tuple[str, str, str]]:
    """(licence, kind, text) of all templates; kinds: header, opening, file."""
    tags = [(name, f"SPDX-License-Identifier: {name}{suffix}") for name in license_texts.TAGGED for suffix in (("", "-only", "-or-later") if "GPL" in name else ("",))]
    out = [(name, "header", text) for name, texts in license_texts.HEADERS.items() for text in texts] + [(name, "header", text) for name, text in tags]
    out += [(name, "opening", text) for name, texts in license_texts.OPENINGS.items() for text in texts]
    return sorted(out + [(name, "file", text) for name, texts in license_texts.BODIES.items() for text in texts])


@dataclass(frozen=True)
class Template:
    number: int
    license: str
    kind: str
    words: tuple[str, ...]
    weights: dict[str, float]
    norm: float
    anchors: frozenset[str]


class Templates:
    def __init__(self, texts: list[tuple[str, str, str]]):
        counted = [(name, kind, tuple(_words(text))) for name, kind, text in texts]
        spread = Counter(w for _, _, words in counted for w in set(words))
        self.idf = {w: math.log(1 + len(counted) / n) for w, n in sorted(spread.items())}
        self.other = max(self.idf.values())
        self.rank = {name: -i for i, name in enumerate(sorted({name for name, _, _ in counted}))}
        licenses = {w: len({name for name, _, words in counted if w in words}) for w in self.idf}
        self.every: list[Template] = []
        for i, (name, kind, words) in enumerate(counted):
            weights = {w: n * self.idf[w] for w, n in sorted(Counter(words).items())}
            whole = sum(v * v for v in weights.values())
            left, anchors = whole, set()
            for w in sorted(weights, key=lambda w: (w in ORDINARY, licenses[w], -len(w), w)):
                if left < 0.999 * FILE_COSINE**2 * whole:
                    break
                anchors.add(w)
                left -= weights[w] ** 2
            self.every.append(Template(i, name, kind, words, weights, math.sqrt(whole), frozenset(anchors)))
        self.anchors = sorted({w for t in self.every for w in t.anchors})

    def spots(self) -> dict[str, list[tuple[int, int, int, bool]]]:
        """For each anchor word: the templates that look for windows, the place of the word, the length, whether an opening."""
        out: dict[str, list[tuple[int, int, int, bool]]] = {}
        for t in self.every:
            for place, w in enumerate(t.words):
                if t.kind != "file" and w in t.anchors:
                    out.setdefault(w, []).append((t.number, place, len(t.words), t.kind == "opening"))
        return dict(sorted(out.items()))

    def pattern(self) -> str:
        """Texts with an anchor word match; words that begin alike share their first letter."""
        by: dict[str, list[str]] = {}
        for w in self.anchors:
            by.setdefault(w[0], []).append(re.escape(w[1:]))
        return "(?i)(?<![a-z0-9])(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by.items())) + ")(?![a-z0-9])"


def parent(path: Column) -> Column:
    """Everything before the last slash; the empty text for what has none."""
    return F.regexp_replace(F.regexp_replace(path, r"^[^/]*$", ""), r"/[^/]*$", "")


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def pieces_of(text: Column, templates: Templates) -> Column:
    """array of (t, words): windows for templates by their numbers, and the whole text with t = -1; null without anchor words."""
    spot = "array<struct<t:int,place:int,size:int,opening:boolean>>"
    table = F.create_map(*[x for w, found in templates.spots().items() for x in (F.lit(w), F.array(*[F.struct(*map(F.lit, f)) for f in found]).cast(spot))])

    def of_words(words: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.map_contains_key(table, F.element_at(words, i)))
        near = F.flatten(F.transform(at, lambda i: F.transform(F.element_at(table, F.element_at(words, i)), lambda a: F.struct(a["t"].alias("t"), (i - a["place"]).alias("start"), a["size"].alias("size"), a["opening"].alias("opening")))))
        good = F.array_distinct(F.filter(near, lambda a: (a["start"] >= 1) & (~a["opening"] | (a["start"] <= OPENING_WORDS))))
        windows = F.transform(good, lambda a: F.struct(a["t"].alias("t"), F.slice(words, a["start"], a["size"]).alias("words")))
        whole = F.array(F.struct(F.lit(-1).alias("t"), words.alias("words")))
        return F.when(F.size(words) > 0, F.concat(windows, whole))

    words = F.filter(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({_WORD})")), lambda w: ~w.isin(*COMMON))
    return F.when(text.rlike(templates.pattern()), _let(words, of_words))


def cosines(pieces: DataFrame, templates: Templates) -> DataFrame:
    """(row, piece, t, words) -> (row, whole, kind, license, cosine) of each piece with its template, and of whole texts with
    every template that they share a word with."""
    spark = pieces.sparkSession
    idf = spark.createDataFrame(list(templates.idf.items()), "word string, idf double")
    weights = spark.createDataFrame([(t.number, w, v) for t in templates.every for w, v in t.weights.items()], "template int, word string, weight double")
    names = spark.createDataFrame([(t.number, t.license, t.kind, t.norm) for t in templates.every], "template int, license string, kind string, template_norm double")
    key = ["row", "piece", "t"]
    counts = pieces.select(*key, F.explode("words").alias("word")).groupBy(*key, "word").agg(F.count("*").alias("n"))
    valued = common.materialize(counts.join(F.broadcast(idf), "word", "left").select(*key, "word", (F.col("n") * F.coalesce("idf", F.lit(templates.other))).alias("v")), "terms")
    norms = valued.groupBy(*key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    shared = valued.join(F.broadcast(weights), "word").where((F.col("t") == -1) | (F.col("t") == F.col("template")))
    dots = shared.groupBy(*key, "template").agg(F.sum(F.col("v") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("template_norm")), 9)
    return dots.join(norms, key).join(F.broadcast(names), "template").select("row", (F.col("t") == -1).alias("whole"), "kind", "license", cosine.alias("cosine"))


def scan(files: DataFrame, templates: Templates | None = None) -> DataFrame:
    """Files (path, text, ..) -> the columns without text, and license, cosine, origin ('header', 'file', 'inherited' or null)
    and inherited_from (a directory).  Columns of the caller that have these names are kept with "_given" after them.

    Directories are reduced to one row each before they are joined, so a directory with many files costs no more.
    """
    templates = templates or Templates(standard())
    made = ("license", "cosine", "origin", "inherited_from")
    given = [F.col(f"`{c}`").alias(f"{c}_given" if c in made else c) for c in files.columns if c not in ("text", "path")]
    kept = F.struct(F.col("path"), *given).alias("kept")
    rows = common.materialize(files.select(kept, pieces_of(F.col("text"), templates).alias("pieces"), F.monotonically_increasing_id().alias("row")), "licenses")
    pieces = rows.where("pieces is not null").select("row", F.posexplode("pieces").alias("piece", "p")).select("row", "piece", "p.t", "p.words").repartition("row", "piece")
    scored = cosines(pieces, templates).where(F.col("cosine") >= F.when(F.col("whole"), FILE_COSINE).otherwise(HEADER_COSINE))
    # the largest cosine, then the first name
    rank = F.element_at(F.create_map([F.lit(x) for pair in templates.rank.items() for x in pair]), F.col("license"))
    match = F.struct("cosine", rank.alias("rank"), "license")
    is_header = ~F.col("whole") & (F.col("kind") == "header")
    own = scored.groupBy("row").agg(F.max(F.when(is_header, match)).alias("header"), F.max(F.when(~is_header, match)).alias("file"))
    marked = common.materialize(rows.drop("pieces").withColumn("_dir", parent(F.col("kept.path"))).join(own, "row", "left"), "licensed")
    given = marked.where("file is not null and _dir is not null").groupBy(F.col("_dir").alias("dir")).agg(F.max("file").alias("gift"))
    steps = F.split(F.col("_dir"), "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, F.lit(1), n), "/").alias("dir")))
    directories = marked.where("header is null and file is null and _dir is not null").groupBy("_dir").agg(F.lit(1).alias("one"))
    near = directories.select("_dir", F.explode(F.array_distinct(ancestors)).alias("a")).select("_dir", "a.depth", "a.dir")
    near = near.join(given, "dir").groupBy("_dir").agg(F.max(F.struct("depth", "dir", "gift")).alias("near"))
    out = marked.join(near, "_dir", "left")
    own_match = F.coalesce("header", "file")
    inherited = F.when(own_match.isNull(), F.col("near.gift"))
    origin = F.when(F.col("header").isNotNull(), "header").when(F.col("file").isNotNull(), "file").when(F.col("near").isNotNull(), "inherited")
    chosen = F.coalesce(own_match, inherited)
    return out.select("kept.*", chosen["license"].alias("license"), chosen["cosine"].alias("cosine"), origin.alias("origin"), F.when(inherited.isNotNull(), F.col("near.dir")).alias("inherited_from"))


def document_path() -> Column:
    """Where a document would lie: its source, a folder for 1,000 ids and one for 50."""
    return F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.floor(F.col("doc_id") / 1000).cast("bigint"), F.lit("/"), F.floor(F.col("doc_id") / 50).cast("bigint"), F.lit("/"), F.col("doc_id"), F.lit(".txt"))


def scanned_documents(docs: DataFrame) -> DataFrame:
    """The query: every document's licence, with paths made of source and id."""
    return scan(docs.select("doc_id", document_path().alias("path"), F.col("text").cast("string").alias("text")))


def scan_sql() -> str:
    """The same over ``documents`` in DuckDB."""
    t = Templates(standard())
    rows = lambda values: "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else repr(x).lower() if isinstance(x, bool) else f"{x!r}::DOUBLE" if isinstance(x, float) else str(x) for x in v) + ")" for v in values) + ")"
    spots = rows([(w, *f) for w, found in t.spots().items() for f in found])
    idf = rows(list(t.idf.items()))
    weights = rows([(x.number, w, v) for x in t.every for w, v in x.weights.items()])
    names = rows([(x.number, x.license, x.kind, x.norm, t.rank[x.license]) for x in t.every])
    common_words = "[" + ", ".join(f"'{w}'" for w in COMMON) + "]"
    anchors = "[" + ", ".join(f"'{w}'" for w in t.anchors) + "]"
    return rf"""
WITH spots AS (SELECT * FROM {spots} v(word, t, place, size, opening)), idf AS (SELECT * FROM {idf} v(word, idf)), weights AS (SELECT * FROM {weights} v(template, word, weight)),
names AS (SELECT * FROM {names} v(template, license, kind, template_norm, rank)),
files AS (
  SELECT doc_id, coalesce(source, '') || '/' || (doc_id // 1000) || '/' || (doc_id // 50) || '/' || doc_id || '.txt' AS path, row_number() OVER () AS rid,
         list_filter(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORD}'), lambda w: NOT list_contains({common_words}, w)) AS words FROM documents),
near AS MATERIALIZED (SELECT rid, words FROM files WHERE list_has_any(words, {anchors})),
places AS (SELECT rid, words, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM near),
windows AS (SELECT DISTINCT rid, t, i - place AS start, size, words FROM places JOIN spots USING (word) WHERE i - place >= 1 AND (NOT opening OR i - place <= {OPENING_WORDS})),
pieces AS MATERIALIZED (SELECT row_number() OVER () AS pid, * FROM (SELECT rid, t, words[start:start + size - 1] AS words FROM windows UNION ALL SELECT rid, -1, words FROM near)),
valued AS MATERIALIZED (
  SELECT pid, rid, t, word, n * coalesce(idf, {t.other!r}::DOUBLE) AS v FROM (SELECT pid, rid, t, word, count(*) AS n FROM (SELECT pid, rid, t, unnest(words) AS word FROM pieces) GROUP BY ALL) LEFT JOIN idf USING (word)),
norms AS (SELECT pid, sqrt(sum(v * v)) AS norm FROM valued GROUP BY 1),
dots AS (SELECT pid, rid, t, template, sum(v * weight) AS dot FROM valued JOIN weights USING (word) WHERE t = -1 OR t = template GROUP BY ALL),
scored AS (SELECT rid, t = -1 AS whole, kind, license, rank, round(dot / (norm * template_norm), 9) AS cosine FROM dots JOIN norms USING (pid) JOIN names USING (template)),
own AS (
  SELECT rid, max({{'cosine': cosine, 'rank': rank, 'license': license}}) FILTER (NOT whole AND kind = 'header') AS header, max({{'cosine': cosine, 'rank': rank, 'license': license}}) FILTER (whole OR kind <> 'header') AS file
  FROM scored WHERE cosine >= CASE WHEN whole THEN {FILE_COSINE} ELSE {HEADER_COSINE} END GROUP BY rid),
marked AS (
  SELECT doc_id, path, rid, regexp_replace(path, '/[^/]*$', '') AS dir, header, file FROM files LEFT JOIN own USING (rid)),
given AS (SELECT dir AS gdir, max(file) AS gift FROM marked WHERE file IS NOT NULL GROUP BY dir),
ancestors AS (
  SELECT d.dir, max({{'depth': len(gdir), 'gdir': gdir, 'gift': gift}}) AS near
  FROM (SELECT DISTINCT dir FROM marked) d JOIN given ON d.dir = gdir OR starts_with(d.dir, gdir || '/') OR gdir = '' GROUP BY d.dir)
SELECT doc_id, path, coalesce(header, file, near.gift).license AS license, coalesce(header, file, near.gift).cosine AS cosine,
       CASE WHEN header IS NOT NULL THEN 'header' WHEN file IS NOT NULL THEN 'file' WHEN near IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN header IS NULL AND file IS NULL THEN near.gdir END AS inherited_from
FROM marked LEFT JOIN ancestors USING (dir)
"""
