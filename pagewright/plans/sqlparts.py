"""DuckDB SQL fragments shared by the oracles (regex over raw html, never our node table)."""

from __future__ import annotations


def host(url: str) -> str:
    return (f"nullif(lower(regexp_replace(regexp_replace(regexp_extract({url}, "
            f"'^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '')")


def regdom(h: str) -> str:
    two = f"regexp_extract({h}, '([^.]+[.][^.]+)$', 1)"
    three = f"regexp_extract({h}, '([^.]+[.][^.]+[.][^.]+)$', 1)"
    suffixes = ("'co.uk','org.uk','ac.uk','gov.uk','me.uk','net.uk','ltd.uk','plc.uk','com.au',"
                "'net.au','org.au','edu.au','gov.au','co.jp','ne.jp','or.jp','ac.jp','co.nz','org.nz',"
                "'com.br','com.cn','co.in','co.za','com.mx','com.tr','co.kr'")
    return (f"CASE WHEN {h} IS NULL THEN NULL WHEN {two} IN ({suffixes}) AND {three} <> '' THEN {three} "
            f"WHEN {two} <> '' THEN {two} ELSE {h} END")


def unescape(x: str) -> str:
    """The entities of the test pages plus &lt; &gt; &#39;, decoded as HTML5 decodes text: the
    legacy names also without the trailing semicolon (a title cut right after ``&amp``).
    ``&amp`` goes last through a sentinel, so the result equals one left-to-right pass."""
    s = x
    for ent, ch in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">")):
        s = f"replace(replace({s}, '&{ent};', '{ch}'), '&{ent}', '{ch}')"
    s = "replace(" + s + ", '&#39;', '''')"
    return f"replace(replace(replace({s}, '&amp;', chr(1)), '&amp', chr(1)), chr(1), '&')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def no_script(html: str) -> str:
    """Delete script/style contents and comments."""
    return (f"regexp_replace(regexp_replace(regexp_replace({html}, '(?s)<script[^>]*>.*?</script>', '', 'g'), "
            f"'(?s)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g')")


def title(html: str) -> str:
    return f"nullif({collapse(unescape(strip_tags(regexp_extract_s(html, '<title[^>]*>(.*?)</title>'))))}, '')"


def regexp_extract_s(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, '(?s){pattern}', {group})"


def resolve(base: str, href: str) -> str:
    """CASE resolver for hrefs without dot segments (the corpus has none)."""
    auth = f"regexp_extract({base}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
    scheme = f"regexp_extract({base}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)"
    nofrag = f"regexp_replace({base}, '#.*$', '')"
    noquery = f"regexp_replace({nofrag}, '[?].*$', '')"
    path = f"regexp_extract({base}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    bdir = f"CASE WHEN {path} = '' THEN '/' ELSE regexp_replace({path}, '[^/]*$', '') END"
    h = f"trim({href}, ' ')"
    return (f"CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {auth} || {h} "
            f"WHEN {h} = '' THEN {nofrag} "
            f"WHEN starts_with({h}, '?') THEN {noquery} || {h} "
            f"WHEN starts_with({h}, '#') THEN {nofrag} || {h} "
            f"ELSE {auth} || {bdir} || {h} END")


# One row per <a ...>...</a> of the page (outside script/style/comments), with its ordinal.
ANCHORS_CTE = f"""
anchors_raw AS (
  SELECT page_id, url, regexp_extract_all({no_script('html')}, '(?s)<a\\s[^>]*>.*?</a>') AS tags
  FROM pages
),
anchors_all AS (
  SELECT page_id, url, unnest(tags) AS tag_src, generate_subscripts(tags, 1) AS ord FROM anchors_raw
),
anchors AS (
  SELECT page_id, url, ord,
         {unescape("regexp_extract(tag_src, '^<a\\s[^>]*href=\"([^\"]*)\"', 1)")} AS href,
         regexp_matches(tag_src, '^<a\\s[^>]*href=') AS has_href,
         nullif({collapse(unescape(strip_tags("regexp_extract(tag_src, '(?s)^<a[^>]*>(.*)</a>$', 1)")))}, '') AS text,
         nullif(trim({unescape("regexp_extract(tag_src, '^<a\\s[^>]*title=\"([^\"]*)\"', 1)")}, ' '), '') AS title
  FROM anchors_all
),
links AS (
  SELECT page_id, url, href, text, title,
         row_number() OVER (PARTITION BY page_id ORDER BY ord) AS pos,
         {resolve('url', 'href')} AS abs_url
  FROM anchors WHERE has_href AND trim(href, ' ') <> ''
),
links_k AS (
  SELECT *, CASE WHEN {regdom(host('abs_url'))} IS NOT NULL
                  AND {regdom(host('abs_url'))} = {regdom(host('url'))}
            THEN 'internal' ELSE 'external' END AS kind
  FROM links
)"""
