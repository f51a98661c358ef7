"""URLs: variants, tokens, platforms, rights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_TOKEN = 6
CONTENTDM = r"(?i)^https?://[^/]+/(?:digital|cdm(?:/ref)?)/collection/[^/]+/id/\d+(?:/.*)?$"


def authority(url: Column) -> Column:
    """Host and port; null for what is no URL."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def variants(url: Column) -> Column:
    """The URL, and it with the other scheme, each with and without a slash at its end; the given one first."""
    u = F.trim(F.coalesce(url, F.lit("")))
    other = F.when(u.startswith("http://"), F.concat(F.lit("https://"), F.substr(u, F.lit(8)))).when(u.startswith("https://"), F.concat(F.lit("http://"), F.substr(u, F.lit(9))))
    turned = lambda b: F.when(b.endswith("/"), F.regexp_replace(b, "/+$", "")).otherwise(F.concat(b, F.lit("/")))
    four = F.array_compact(F.array(u, turned(u), other, turned(other)))
    return F.when(u == "", F.array().cast("array<string>")).otherwise(F.array_distinct(four))


def stable_token(url: Column) -> Column:
    """The longest run of identifier characters of path and query (one with a digit wins a tie, then the first)."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*(?:\?[^#]*)?)", 1)
    tokens = F.filter(F.split(path, "[^A-Za-z0-9_-]+"), lambda t: t != "")
    weight = lambda t: F.length(t) * 2 + t.rlike("[0-9]").cast("int")
    best = F.aggregate(tokens, F.lit(""), lambda a, t: F.when((a == "") | (weight(t) > weight(a)), t).otherwise(a))
    return F.when(F.length(best) >= MIN_TOKEN, best)


def rights_key(uri: Column) -> Column:
    """One form of a rights URI, whatever its scheme and the slashes at its end."""
    return F.regexp_replace(F.replace(uri, F.lit("https://"), F.lit("http://")), "/+$", "")


def is_contentdm(url: Column) -> Column:
    return F.coalesce(url.rlike(CONTENTDM), F.lit(False))


def contentdm_manifest(url: Column) -> Column:
    """The manifest of a page /cdm/ref/collection/<collection>/id/<number>; null for other URLs."""
    found = r"^(https?://[^/]+)/cdm/ref/collection/([^/]*)/id/([^/?#]*)"
    host, collection, number = (F.regexp_extract(url, found, i) for i in (1, 2, 3))
    return F.when(url.rlike(found), F.concat(host, F.lit("/iiif/info/"), collection, F.lit("/"), number, F.lit("/manifest.json")))


def search_url(name: Column, hub: Column) -> Column:
    return F.concat(F.lit("https://dp.la/search?provider="), F.url_encode(F.concat(F.lit('"'), name, F.lit('"'))), F.lit("&partner="), F.url_encode(F.concat(F.lit('"'), hub, F.lit('"'))))


def repaired_scheme(url: Column) -> Column:
    """URLs that begin "https/" get their colon back."""
    return F.when(url.startswith("https/"), F.replace(url, F.lit("https/"), F.lit("https:/"))).otherwise(url)


def owner_of_reference(url: Column) -> Column:
    return F.when(url.contains("/item/"), F.substring_index(url, "/item/", -1))


def category_name(name: Column) -> Column:
    return F.replace(F.replace(F.replace(name, F.lit("_"), F.lit(" ")), F.lit("%26"), F.lit("&")), F.lit("%27"), F.lit("'"))


# The request for a whole image in its full size, and the path segment that image services are under.
FULL_SIZE, SERVICE = "/full/max/0/default.jpg", "iiif"


def full_size_image(url: Column) -> Column:
    """The URL of an image service, or of any request to it, as the request for the whole image; null for other URLs.

    The identifier comes first in the path, or after the service's segment, which up to two others precede; an identifier
    with slashes is known only where the service's segment comes first.
    """
    host = F.regexp_extract(url, r"^(https?://[^/]+)/", 1)
    path = F.regexp_extract(url, r"^https?://[^/]+/(.*)$", 1)
    bare = F.regexp_replace(path, "/$", "")

    def at(parts: Column, before: int) -> Column:
        """The identifier follows ``before`` segments, the last of which is the service's."""
        return F.lit(True) if before == 0 else F.try_element_at(parts, F.lit(before)) == SERVICE

    whole, asked = F.split(bare, "/", -1), F.split(path, "/", -1)
    found = F.when((F.try_element_at(asked, F.lit(1)) == SERVICE) & (F.size(asked) > 1), path)
    filled = F.forall(asked, lambda x: x != "")
    request = filled & F.try_element_at(asked, F.lit(-1)).rlike(r"^[^.]+\.")
    for before in (3, 2, 1, 0):
        found = F.when(request & (F.size(asked) == before + 5) & at(asked, before), F.array_join(F.slice(asked, 1, before + 1), "/")).otherwise(found)
    for before in (3, 2, 1, 0):
        found = F.when(F.forall(whole, lambda x: x != "") & (F.size(whole) == before + 1) & at(whole, before), bare).otherwise(found)
    return F.when(host != "", F.concat(host, F.lit("/"), found, F.lit(FULL_SIZE)))


def file_page(title: Column) -> Column:
    """The URL of a file's page."""
    return F.concat(F.lit("https://commons.wikimedia.org/wiki/File:"), F.replace(title, F.lit(" "), F.lit("_")))


def is_rights_url(url: Column) -> Column:
    """Of a site of rights statements, or of an archive's pages about them."""
    host, path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    under = lambda name: (host == name) | host.endswith("." + name)
    return under("rightsstatements.org") | (under("archives.gov") & path.startswith("/social-media/flickr-faqs"))
