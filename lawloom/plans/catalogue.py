"""Named queries over a data set and their SQL.

The extractors run on the synthetic bills of `bills_view`; each SQL form is written for
DuckDB on its own terms (its regular expressions have no look-around, for instance).
Lists are compared as text joined by |.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning, extract, filenames, scores
from ..functions import patterns as P
from ..functions.text import joined, normalised
from ..operators import changes, quality, rosters, selection
from ..operators.documents import bill_documents, bill_records, bill_versions, register_views
from ..publish import config_lines, session_numbers
from ..reports import field_changes
from ..sources import readers
from ..sources.listing import hrefs, listed_files, listed_sessions
from ..sources.sinks import document_json
from .bills_view import FOR_DUCKDB, bills

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# What rates and flags are made of; other fields are left out of their plans.
RATED = ("bill_id", "session", "title", "sponsors", "committee", "amended_code_refs", "extraction_confidence")
BASE_URL = "https://bills.example.org/files/"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# ------------------------------------------------------------ pieces of SQL

VIEW = f"bills as ({FOR_DUCKDB})"


def strip_(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def norm_(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def found_(x: str, p: str, g: int = 1) -> str:
    return f"nullif(regexp_extract({x}, {q(p)}, {g}), '')"


def distinct_(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


ORD = q(f"(?i){P.ORDINAL_LINE}")
BARE = f"""bare as (
  select *, case when p > 0 then array_to_string(ls[p:], chr(10)) else raw_text end as t from (
    select *, list_position(list_transform(ls, lambda l: regexp_matches({strip_('l')}, {ORD})
        or regexp_matches({strip_("regexp_replace(l, " + q(P.MARGIN_NUMBER) + ", '')")}, {ORD})), true) as p
    from (select *, string_split(raw_text, chr(10)) as ls from bills)))"""
HEADS = f"heads as (select *, {norm_('t')} as n, {norm_('substring(t, 1, 2000)')} as n2000, {norm_('substring(t, 1, 2500)')} as n2500, {norm_('substring(t, 1, 800)')} as n800 from bare)"
ID_ = f"coalesce({found_('t', P.BILL_ID, 0)}, {found_('n', P.SESSION_ORDINAL)} || '-LD-' || lpad(coalesce({found_('n', P.DOCUMENT_NUMBER)}, {found_('n', P.BARE_NUMBER)}), 4, '0'))"
SESSION_ = f"coalesce({found_('t', P.SESSION_ID)}, {found_('n2000', P.SESSION_ORDINAL)}, {found_('n2000', P.SESSION_STATE)})"


def date_(x: str, p: str) -> str:
    return f"try_strptime(concat_ws(' ', {found_(x, p, 3)}, substring({found_(x, p, 1)}, 1, 3), {found_(x, p, 2)}), '%Y %b %d')::date"


DATE_ = f"coalesce({date_('n2500', P.DATE_IN_HOUSE)}, {date_('n2500', P.DATE_IN_SENATE)}, {date_('n800', P.DATE)})"
HIT_ = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip_('x')}), lambda x: contains(x, 'An Act') or contains(x, 'Resolve'))[1]"
TITLE_ = f"""regexp_replace(regexp_replace({strip_(f"substring(({HIT_}), case when contains(({HIT_}), 'An Act') then instr(({HIT_}), 'An Act') else instr(({HIT_}), 'Resolve') end)")}, '^"+|"+$', '', 'g'), '^''+|''+$', '', 'g')"""
STOP_ = f"regexp_replace({strip_(found_('n2500', P.COMMITTEE_STOP))}, {q('(?i)' + P.COMMITTEE_TAIL)}, '')"
COMMITTEE_ = f"coalesce(nullif({strip_(found_('n2500', P.COMMITTEE_ACTION))}, ''), nullif({STOP_}, ''), nullif({strip_(found_('n2500', P.COMMITTEE_OTHER))}, ''))"
SN_ = rf"regexp_replace(n2500, {q(P.LOOSE_HYPHEN)}, '\1-\2', 'g')"
BLOCK_ = norm_(f"coalesce({found_(SN_, P.COSPONSORS)}, '')")
NAMES_ = f"list_concat(regexp_extract_all({SN_}, {q(P.PRESENTED_OF)}, 1), regexp_extract_all({SN_}, {q(P.PRESENTED_ALONE)}, 1), regexp_extract_all({BLOCK_}, {q(P.COSPONSOR_OF)}, 1), regexp_extract_all({BLOCK_}, {q(P.COSPONSOR_ALONE)}, 1))"
NOT_NAMES_ = "[" + ", ".join(q(w) for w in P.NOT_NAMES) + "]"
GOOD_ = f"list_transform(list_filter({NAMES_}, lambda x: len(regexp_split_to_array(x, '\\s+')) <= 2 and not list_has_any(regexp_split_to_array(x, '\\s+'), {NOT_NAMES_})), lambda x: regexp_replace(x, '\\s*-\\s*', '-', 'g'))"
REFS_ = rf"""list_concat(list_transform(regexp_extract_all(t, {q(P.TITLE_REF)}), lambda m: regexp_replace(m, {q(P.TITLE_REF)}, 'Title \1, Section \2')),
  list_transform(regexp_extract_all(t, {q(P.MRSA_REF)}), lambda m: regexp_replace(m, {q(P.MRSA_REF)}, '\1 MRSA §\2')))"""
BODY_ = f"""{strip_(f'''array_to_string(list_filter(list_transform(list_filter(string_split(t, chr(10)), lambda x: not regexp_matches(x, {q(P.LINE_NUMBER)})),
  lambda x: regexp_replace(x, {q(P.NUMBER_PREFIX)}, '')), lambda x: {strip_('x')} <> '' and not regexp_matches({strip_('x')}, {q('(?i)' + P.HEADER)}) and not regexp_matches({strip_('x')}, {q(P.HEADER_ID)})), chr(10))''')}"""
DOCS = f"""raw_docs as (select *, {ID_} as bill_id, {TITLE_} as title, {SESSION_} as session, {GOOD_} as people, {DATE_} as introduced_date, {COMMITTEE_} as committee, {REFS_} as refs, {BODY_} as body_text from heads),
docs as (select *, {distinct_('people')} as sponsors, {distinct_('refs')} as amended_code_refs from raw_docs),
scored as (select *, 0.5::double + (case when coalesce(bill_id, '') <> '' then 0.2 else 0 end)::double + (case when coalesce(title, '') <> '' then 0.1 else 0 end)::double
  + (case when coalesce(session, '') <> '' then 0.1 else 0 end)::double + (case when len(sponsors) > 0 then 0.1 else 0 end)::double as extraction_confidence from docs)"""
FULL = f"with {VIEW}, {BARE}, {HEADS}, {DOCS} "
HEAD = f"with {VIEW}, {BARE}, {HEADS} "
PLAIN = f"with {VIEW} "


def stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bills(spark, sf_dir).select("doc_id", "filename", "raw_text", cleaning.without_preamble(F.col("raw_text")).alias("t"))


def documents(spark: SparkSession, sf_dir: str, version: str = "standard", fields: tuple[str, ...] | None = None) -> DataFrame:
    return bill_documents(bills(spark, sf_dir), version=version, fields=fields)


# ------------------------------------------------------------ file names

FN = q(P.FILENAME)
KIND_ = f"split_part({found_('filename', P.FILENAME, 4)}, '_', 1)"
PARSED_ = f"""select doc_id, filename, cast({found_('filename', P.FILENAME, 1)} as int) as session, {found_('filename', P.FILENAME, 3)} as ld_number,
  case {found_('filename', P.FILENAME, 2)} when 'LD' then 'bill' when 'SP' then 'sp_bill' when 'HP' then 'hp_bill' when 'HO' then 'ho_bill' end as document_type,
  {found_('filename', P.FILENAME, 4)} as amendment_code,
  case {KIND_} when 'CA' then 'Committee Amendment' when 'HA' then 'House Amendment' when 'SA' then 'Senate Amendment' else {KIND_} end as amendment_type,
  case nullif(regexp_extract({found_('filename', P.FILENAME, 4)}, {q(P.CHAMBER)}, 1), '') when 'H' then 'House' when 'S' then 'Senate' end as chamber from bills"""


@query(PLAIN + f"select doc_id, filename from bills where regexp_matches(filename, {FN})")
def filename_valid(spark, sf_dir):
    return selection.valid_filenames(bills(spark, sf_dir)).select("doc_id", "filename")


@query(PLAIN + f"select count(*) filter (regexp_matches(filename, {FN})) as n_valid, count(*) filter (not regexp_matches(filename, {FN})) as n_skipped from bills")
def filename_counts(spark, sf_dir):
    return selection.filename_counts(bills(spark, sf_dir))


@query(PLAIN + PARSED_)
def parse_filename(spark, sf_dir):
    parts = filenames.parsed(F.col("filename"))
    return bills(spark, sf_dir).select("doc_id", "filename", *[v.alias(k) for k, v in parts.items() if k != "bill_type"])


@query(PLAIN + f", p as ({PARSED_}) select session, document_type, count(*) as n from p where session is not null group by all")
def doc_type_counts(spark, sf_dir):
    return parse_filename(spark, sf_dir).where("session IS NOT NULL").groupBy("session", "document_type").agg(F.count("*").alias("n"))


@query(PLAIN + f"select doc_id, filename from bills where regexp_matches(filename, {FN}) and {found_('filename', P.FILENAME, 4)} is null")
def base_bills(spark, sf_dir):
    return selection.base_bills(bills(spark, sf_dir)).select("doc_id", "filename")


@query(PLAIN + f"select doc_id, filename from bills where regexp_matches(filename, {FN}) and doc_id % 3 <> 0")
def increment_anti(spark, sf_dir):
    b = bills(spark, sf_dir)
    done = b.where("doc_id % 3 = 0").select("filename")
    return selection.not_yet(selection.valid_filenames(b), done, "filename").select("doc_id", "filename")


@query(PLAIN + f", p as ({PARSED_}) select session, count(*) as n from p where session in (125, 131) group by 1")
def session_union(spark, sf_dir):
    p = parse_filename(spark, sf_dir)
    return p.where("session = 125").unionByName(p.where("session = 131")).groupBy("session").agg(F.count("*").alias("n"))


# ------------------------------------------------------------ text


@query(f"with {VIEW}, {BARE} select doc_id, t as text from bare")
def strip_preamble(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", F.col("t").alias("text"))


@query(PLAIN + f"select line, count(*) as n from (select unnest(string_split(raw_text, chr(10))) as line from bills) where regexp_matches(line, {q(P.LINE_NUMBER)}) group by 1")
def line_number_filter(spark, sf_dir):
    lines = bills(spark, sf_dir).select(F.explode(F.split("raw_text", "\n", -1)).alias("line"))
    return lines.where(cleaning.is_line_number(F.col("line"))).groupBy("line").agg(F.count("*").alias("n"))


@query(PLAIN + f"select line, count(*) as n from (select unnest(string_split(raw_text, chr(10))) as line from bills) where regexp_matches({strip_('line')}, {q('(?i)' + P.HEADER)}) or regexp_matches({strip_('line')}, {q(P.HEADER_ID)}) group by 1")
def header_footer_filter(spark, sf_dir):
    lines = bills(spark, sf_dir).select(F.explode(F.split("raw_text", "\n", -1)).alias("line"))
    return lines.where(cleaning.is_header(F.col("line"))).groupBy("line").agg(F.count("*").alias("n"))


@query(HEAD + f"select doc_id, {BODY_} as body_text from heads")
def clean_body(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", cleaning.clean_body(F.col("t")).alias("body_text"))


@query(PLAIN + f"select doc_id, {norm_('raw_text')} as text from bills")
def norm_whitespace(spark, sf_dir):
    return bills(spark, sf_dir).select("doc_id", normalised(F.col("raw_text")).alias("text"))


@query(PLAIN + rf"select doc_id, regexp_replace(raw_text, {q(P.LOOSE_HYPHEN)}, '\1-\2', 'g') as text from bills")
def hyphen_repair(spark, sf_dir):
    return bills(spark, sf_dir).select("doc_id", extract.repair_hyphens(F.col("raw_text")).alias("text"))


@query(PLAIN + "select doc_id, substring(raw_text, 1, 400) as head_400, substring(raw_text, 1, 800) as head_800, array_to_string(string_split(raw_text, chr(10))[101:130], chr(10)) as lines_100_130, substring(raw_text, 1001, 1000) as chars_1000_2000 from bills")
def previews(spark, sf_dir):
    return selection.previews(bills(spark, sf_dir), "raw_text").select("doc_id", "head_400", "head_800", "lines_100_130", "chars_1000_2000")


# ------------------------------------------------------------ metadata


@query(HEAD + f"select doc_id, {ID_} as bill_id from heads")
def bill_id(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.bill_id(F.col("t")).alias("bill_id"))


@query(HEAD + f"select doc_id, {TITLE_} as title from heads")
def title(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.title(F.col("t")).alias("title"))


@query(HEAD + f"select doc_id, {SESSION_} as session from heads")
def session_text(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.session(F.col("t")).alias("session"))


@query(HEAD + f"select doc_id, {DATE_} as introduced_date from heads")
def introduced_date(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.introduced_date(F.col("t")).alias("introduced_date"))


@query(HEAD + f"select doc_id, {COMMITTEE_} as committee from heads")
def committee(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.committee(F.col("t")).alias("committee"))


@query(FULL + "select doc_id, array_to_string(sponsors, '|') as sponsors from docs")
def sponsors(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", joined(extract.sponsors(F.col("t"))).alias("sponsors"))


@query(FULL + "select doc_id, array_to_string(amended_code_refs, '|') as code_refs from docs")
def code_refs(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", joined(extract.code_refs(F.col("t"))).alias("code_refs"))


@query(FULL + "select doc_id, extraction_confidence from scored")
def confidence(spark, sf_dir):
    return documents(spark, sf_dir, fields=("extraction_confidence",)).select("doc_id", "extraction_confidence")


_DOC_COLUMNS = "doc_id, bill_id, title, session, body_text, extraction_confidence, array_to_string(sponsors, '|') as sponsors, introduced_date, committee, array_to_string(amended_code_refs, '|') as amended_code_refs"


@query(FULL + f"select {_DOC_COLUMNS} from scored")
def bill_document(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", "bill_id", "title", "session", "body_text", "extraction_confidence", joined(F.col("sponsors")).alias("sponsors"), "introduced_date", "committee", joined(F.col("amended_code_refs")).alias("amended_code_refs"))


@query(
    FULL
    + f""", p as ({PARSED_}) select p.session, p.ld_number, p.document_type, p.amendment_code, p.amendment_type, p.chamber, s.body_text as text, s.extraction_confidence, s.title,
  array_to_string(s.sponsors, '|') as sponsors, s.committee, array_to_string(s.amended_code_refs, '|') as amended_code_refs, '{BASE_URL}' || p.filename || '.pdf' as source_url, p.filename as source_filename
  from p join scored s using (doc_id) where p.session is not null"""
)
def bill_record(spark, sf_dir):
    r = bill_records(documents(spark, sf_dir), BASE_URL)
    return r.drop("scraped_at").withColumns({c: joined(F.col(c)) for c in ("sponsors", "amended_code_refs")})


# ------------------------------------------------------------ rosters

ROSTER = [(1, "SMITH"), (2, "JONES"), (3, "BEEBE-CENTER"), (4, "BROWN"), (5, "BROWN"), (6, "OBRIAN"), (7, "VAN BUREN"), (8, "LEE")]
ROSTER_ = "roster as (select * from (values " + ", ".join(f"({i}::bigint, '{n}')" for i, n in ROSTER) + ") r(legislator_id, last_name))"


def roster(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROSTER, "legislator_id long, last_name string")


@query(FULL + f"select doc_id, array_to_string(list_filter(sponsors, lambda s: list_contains([{', '.join(q(n) for _, n in ROSTER)}], upper(s))), '|') as sponsors from docs")
def validate_sponsors(spark, sf_dir):
    d = documents(spark, sf_dir, fields=("sponsors",)).select("doc_id", "sponsors")
    return rosters.validate_sponsors(d, roster(spark)).select("doc_id", joined(F.col("sponsors")).alias("sponsors"))


@query(ORACLES["validate_sponsors"])
def validate_sponsors_large(spark, sf_dir):
    """The same names in a roster that is joined."""
    more = spark.range(rosters.SMALL + 1).select(F.col("id").alias("legislator_id"), F.concat(F.lit("NAME "), F.col("id")).alias("last_name"))
    d = documents(spark, sf_dir, fields=("sponsors",)).select("doc_id", "sponsors")
    return rosters.validate_sponsors(d, roster(spark).union(more)).select("doc_id", joined(F.col("sponsors")).alias("sponsors"))


@query(FULL + "select doc_id, array_to_string(sponsors, '|') as sponsors from docs")
def validate_sponsors_noop(spark, sf_dir):
    d = documents(spark, sf_dir, fields=("sponsors",)).select("doc_id", "sponsors")
    return rosters.validate_sponsors(d, None).select("doc_id", joined(F.col("sponsors")).alias("sponsors"))


_PLAIN_ = "upper(regexp_replace({}, '[^A-Za-z]', '', 'g'))"
_LINKS = f""", {ROSTER_}, s as (select distinct unnest(sponsors) as sponsor from docs),
  r as (select {_PLAIN_.format('last_name')} as plain, count(*) as n_matches, min(legislator_id) as legislator_id from roster group by 1)"""


def _sponsor_names(spark, sf_dir):
    return quality.distinct_sponsors(documents(spark, sf_dir, fields=("sponsors",))).select("sponsor")


@query(FULL + _LINKS + f" select sponsor, legislator_id, coalesce(n_matches, 0) as n_matches, coalesce(n_matches > 1, false) as ambiguous from s left join r on {_PLAIN_.format('sponsor')} = plain")
def link_exact(spark, sf_dir):
    return rosters.link_exactly(_sponsor_names(spark, sf_dir), roster(spark))


@query(
    FULL
    + _LINKS
    + f""", rest as (select sponsor, {_PLAIN_.format('sponsor')} as a from s where {_PLAIN_.format('sponsor')} not in (select plain from r)),
  near as (select sponsor, legislator_id, levenshtein(a, {_PLAIN_.format('last_name')}) as d from rest, roster where levenshtein(a, {_PLAIN_.format('last_name')}) <= 2)
  select sponsor, arg_min(legislator_id, d * 1000 + legislator_id) as legislator_id, cast(min(d) as int) as distance from near group by 1"""
)
def link_fuzzy(spark, sf_dir):
    return rosters.link_nearly(_sponsor_names(spark, sf_dir), roster(spark))


_NEAR_ = f""", rest as (select sponsor, {_PLAIN_.format('sponsor')} as a from s where {_PLAIN_.format('sponsor')} not in (select plain from r)),
  pairs as (select sponsor, legislator_id, levenshtein(a, {_PLAIN_.format('last_name')}) as d from rest, roster where a <> '' and levenshtein(a, {_PLAIN_.format('last_name')}) <= 2),
  near as (select * from pairs qualify d = min(d) over (partition by sponsor))"""


@query(FULL + _LINKS + _NEAR_ + " select sponsor, min(legislator_id) as legislator_id, count(*) as n_matches, count(*) > 1 as ambiguous from near group by 1")
def link_fuzzy_ambiguity(spark, sf_dir):
    found = rosters.near_matches(_sponsor_names(spark, sf_dir), roster(spark)).where("n_matches > 0")
    return found.select("sponsor", "legislator_id", "n_matches", "ambiguous")


@query(FULL + _LINKS + _NEAR_ + " select sponsor from rest where sponsor not in (select sponsor from near)")
def unmatched_sponsors(spark, sf_dir):
    return rosters.unmatched(_sponsor_names(spark, sf_dir), roster(spark))


@query(FULL + _LINKS + f", l as (select n_matches from s left join r on {_PLAIN_.format('sponsor')} = plain) select count(*) as n_sponsors, count(n_matches) as n_linked, count(*) filter (n_matches > 1) as n_ambiguous from l")
def match_rate(spark, sf_dir):
    return rosters.match_rate(link_exact(spark, sf_dir))


@query(FULL + f"select distinct sponsor, list_has_any(string_split(sponsor, ' '), {NOT_NAMES_}) as suspicious from (select unnest(sponsors) as sponsor from docs)")
def distinct_sponsors(spark, sf_dir):
    return quality.distinct_sponsors(documents(spark, sf_dir, fields=("sponsors",)))


# ------------------------------------------------------------ listings and cards

_HREF_ = q("""(?i)<a\\s[^>]*?href\\s*=\\s*["']([^"']*)["']""")


@query(f"select page_id, len(regexp_extract_all(html, {_HREF_}, 1)) as n_links, array_to_string(regexp_extract_all(html, {_HREF_}, 1), '|') as hrefs from pages")
def listing_hrefs(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.size(hrefs(F.col("html"))).cast("long").alias("n_links"), joined(hrefs(F.col("html"))).alias("hrefs"))


def _landed(spark, sf_dir):
    """Listing pages as a server would give them, one for each hundred documents."""
    b = bills(spark, sf_dir)
    link = F.concat(F.lit('<A class="x" HREF="/files/'), F.col("filename"), F.when(F.col("doc_id") % 5 == 0, ".PDF").when(F.col("doc_id") % 5 == 1, ".html").otherwise(".pdf"), F.lit('">x</A>'))
    return b.groupBy(F.floor(F.col("doc_id") / 100).alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", link.alias("l")))), lambda x: x["l"]), "\n").alias("html"))


@query(PLAIN + "select filename from bills where doc_id % 5 not in (0, 1)")
def listing_pdfs(spark, sf_dir):
    return listed_files(_landed(spark, sf_dir))


@query(PLAIN + f", p as ({PARSED_}) select distinct cast(session as varchar) as session from p where session is not null")
def listing_sessions(spark, sf_dir):
    p = parse_filename(spark, sf_dir).where("session IS NOT NULL")
    html = p.groupBy(F.col("session").alias("s")).agg(F.format_string('<a href="../">up</a><a href="/Open/%d/">x</a>', F.first("session")).alias("html"))
    return listed_sessions(html)


@query(
    PLAIN
    + f""", p as ({PARSED_}) select distinct session, '  - config_name: "' || session || '"' || chr(10) || '    data_files:' || chr(10) || '      - split: train' || chr(10) || '        path: "data/' || session || '/*.parquet"' as config from p where session is not null"""
)
def card_sessions(spark, sf_dir):
    p = parse_filename(spark, sf_dir).where("session IS NOT NULL")
    paths = p.select(F.concat(F.lit("data/"), F.col("session")).alias("path")).union(p.limit(1).select(F.lit("data/notes")))
    return config_lines(session_numbers(paths))


# ------------------------------------------------------------ quality


def clean_(body: str) -> str:
    n = lambda p: f"len(regexp_extract_all({body}, {q(p)}))"
    return f"greatest(0::double, 100::double - ({n(P.STRAY_NUMBERS)} * 0.5::double + {n(P.PAGE_HEADERS)} * 2 + {n(P.PAGE_NUMBERS)} + {n(P.DISCLAIMERS)} * 2))"


def meta_(bill: str = "bill_id", session: str = "session") -> str:
    some = lambda c: f"(case when coalesce({c}, '') <> '' then 1 else 0 end)"
    return f"({some(bill)} + {some(session)} + (case when coalesce(title, '') not in ('', 'Unknown Title') then 1 else 0 end) + (case when len(sponsors) > 0 then 1 else 0 end) + {some('committee')} + (case when introduced_date is not null then 1 else 0 end) + (case when len(amended_code_refs) > 0 then 1 else 0 end))"


@query(FULL + f"select doc_id, cast({meta_()} as int) as metadata_score from docs")
def metadata_score(spark, sf_dir):
    return quality.scored(documents(spark, sf_dir)).select("doc_id", "metadata_score")


@query(FULL + f"select doc_id, {clean_('raw_text')} as before, {clean_('body_text')} as after from docs")
def cleanliness(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", scores.cleanliness(F.col("raw_text")).alias("before"), scores.cleanliness(F.col("body_text")).alias("after"))


@query(FULL + f"select doc_id, printf('Metadata: %d/7, Cleanliness: %.1f/100, Confidence: %.2f', {meta_()}, {clean_('body_text')}, extraction_confidence) as report from scored")
def metrics_report(spark, sf_dir):
    d = quality.scored(documents(spark, sf_dir))
    return d.select("doc_id", scores.report_line(F.col("metadata_score"), F.col("cleanliness_score"), F.col("extraction_confidence")).alias("report"))


def _two_versions(spark, sf_dir) -> DataFrame:
    """Two thirds of the comparisons gain (from weaker versions), a third loses."""
    d = bill_versions(bills(spark, sf_dir), "direct_only", "uncleaned", "standard")
    weak, rough, strong = (F.col(v) for v in ("direct_only", "uncleaned", "standard"))
    before = F.when(F.col("doc_id") % 3 == 0, weak).when(F.col("doc_id") % 3 == 1, rough).otherwise(strong)
    after = F.when(F.col("doc_id") % 3 != 2, strong).when(F.col("doc_id") % 2 == 0, weak).otherwise(rough)
    return quality.compared_within(d, before, after, "doc_id")


_WEAK_CONF = "(extraction_confidence - (case when bill_id is not null and wid is null then 0.2::double else 0 end) - (case when session is not null and wsess is null then 0.1::double else 0 end))"
_DELTAS = (
    FULL
    + f""", v as (select *, {found_('t', P.BILL_ID, 0)} as wid, {found_('t', P.SESSION_ID)} as wsess from scored),
  w as (select *, 0.5::double + (case when wid is not null then 0.2 else 0 end)::double + (case when coalesce(title, '') <> '' then 0.1 else 0 end)::double + (case when wsess is not null then 0.1 else 0 end)::double + (case when len(sponsors) > 0 then 0.1 else 0 end)::double as wconf,
    cast({meta_()} as int) as m, cast({meta_('wid', 'wsess')} as int) as wm, {clean_('body_text')} as c, {clean_('t')} as rc from v),
  e as (select doc_id,
    case when doc_id % 3 = 0 then m - wm when doc_id % 3 = 1 then 0 when doc_id % 2 = 0 then wm - m else 0 end as metadata_delta,
    case when doc_id % 3 = 0 then 0::double when doc_id % 3 = 1 then c - rc when doc_id % 2 = 0 then 0::double else rc - c end as cleanliness_delta,
    case when doc_id % 3 = 0 then extraction_confidence - wconf when doc_id % 3 = 1 then 0::double when doc_id % 2 = 0 then wconf - extraction_confidence else 0::double end as confidence_delta from w),
  f as (select *, concat_ws(', ', case when metadata_delta > 0 then '+' || metadata_delta || ' metadata fields' end, case when cleanliness_delta > 5 then '+' || printf('%.1f', cleanliness_delta) || ' cleanliness' end, case when confidence_delta > 0.05 then '+' || printf('%.2f', confidence_delta) || ' confidence' end) as gains from e),
  g as (select *, metadata_delta >= 0 and cleanliness_delta >= -5 and gains <> '' as accepted,
    case when metadata_delta < 0 then 'Metadata regression: lost extracted fields' when cleanliness_delta < -5 then 'Text cleanliness regression: ' || printf('%.1f', cleanliness_delta) when gains <> '' then gains else 'No measurable improvement' end as reasoning from f)"""
)


@query(_DELTAS + " select doc_id, metadata_delta, cleanliness_delta, accepted, reasoning from g")
def compare_extractions(spark, sf_dir):
    return _two_versions(spark, sf_dir).select("doc_id", "metadata_delta", "cleanliness_delta", "accepted", "reasoning")


@query(_DELTAS + " select count(*) as total, count(*) filter (accepted) as n_accepted, 100.0::double * count(*) filter (accepted) / count(*) as success_rate, round(avg(metadata_delta), 6) as avg_metadata_delta, round(avg(cleanliness_delta), 6) as avg_cleanliness_delta from g")
def accept_summary(spark, sf_dir):
    s = quality.accept_summary(_two_versions(spark, sf_dir))
    return s.select("total", "n_accepted", "success_rate", F.round("avg_metadata_delta", 6).alias("avg_metadata_delta"), F.round("avg_cleanliness_delta", 6).alias("avg_cleanliness_delta"))


@query(_DELTAS + " select doc_id, metadata_delta, cleanliness_delta, (metadata_delta + cleanliness_delta / 10)::double as score from g order by score desc, doc_id limit 1")
def best_iteration(spark, sf_dir):
    return quality.best_iteration(_two_versions(spark, sf_dir), "doc_id").select("doc_id", "metadata_delta", "cleanliness_delta", "score")


@query(_DELTAS + " select doc_id, metadata_delta >= 0 and cleanliness_delta >= 0 and (metadata_delta > 0 or cleanliness_delta > 0) as accepted from g")
def compare_strictly(spark, sf_dir):
    d = _two_versions(spark, sf_dir)
    return d.select("doc_id", scores.accepted_strictly(F.col("metadata_delta"), F.col("cleanliness_delta")).alias("accepted"))


@query(
    FULL
    + f""", v as (select doc_id, bill_id, session, {found_('t', P.BILL_ID, 0)} as wid, {found_('t', P.SESSION_ID)} as wsess from docs),
  u as (select doc_id, 'bill_id' as field, wid as a, bill_id as b from v union all select doc_id, 'session', wsess, session from v)
  select doc_id, field, a as before, b as after, case when a is not distinct from b then '—' when coalesce(a, '') = '' and coalesce(b, '') <> '' then '✅' when coalesce(a, '') <> '' and coalesce(b, '') <> '' then '🔄' else '—' end as status from u"""
)
def field_status(spark, sf_dir):
    return field_changes(documents(spark, sf_dir, "direct_only"), documents(spark, sf_dir), "doc_id", ("bill_id", "session"))


def rates_(by: str = "") -> str:
    some = lambda c: f"avg(case when coalesce({c}, '') <> '' then 1.0::double else 0 end)"
    return f"""select {by} count(*) as total_bills, count(*) as successful_extractions, {some('bill_id')} as bill_id_rate, {some('session')} as session_rate, avg(case when coalesce(title, '') not in ('', 'Unknown Title') then 1.0::double else 0 end) as title_rate,
  avg(case when len(sponsors) > 0 then 1.0::double else 0 end) as sponsor_rate, avg(len(sponsors)::double) as avg_sponsors, {some('committee')} as committee_rate, avg(case when len(amended_code_refs) > 0 then 1.0::double else 0 end) as code_ref_rate, round(avg(extraction_confidence), 9) as avg_confidence from scored"""


@query(FULL + rates_())
def quality_rates(spark, sf_dir):
    return quality.quality_rates(documents(spark, sf_dir, fields=RATED)).withColumn("avg_confidence", F.round("avg_confidence", 9))


@query(FULL + rates_("session as bill_session,") + " where session is not null group by session")
def quality_by_session(spark, sf_dir):
    d = documents(spark, sf_dir, fields=RATED).where("session IS NOT NULL").withColumn("bill_session", F.col("session"))
    return quality.quality_rates(d, "bill_session").withColumn("avg_confidence", F.round("avg_confidence", 9))


@query(FULL + f", r as ({rates_()}) select sponsor_rate >= 0.6 as sponsor_ok, committee_rate >= 0.6 as committee_ok, session_rate >= 0.95 as session_ok, sponsor_rate >= 0.6 and committee_rate >= 0.6 and session_rate >= 0.95 as gate_passed from r")
def gate_thresholds(spark, sf_dir):
    return quality.gated(quality.quality_rates(documents(spark, sf_dir, fields=RATED))).select("sponsor_ok", "committee_ok", "session_ok", "gate_passed")


@query(FULL + "select doc_id, extraction_confidence < 0.5 or title is null or session is null as low_quality from scored")
def low_quality_flags(spark, sf_dir):
    return quality.flagged(documents(spark, sf_dir, fields=RATED)).select("doc_id", "low_quality")


@query(FULL + "select avg(case when len(sponsors) > 0 then 1.0::double else 0 end) as sponsor_rate from scored where not coalesce(contains(title, 'Resolve'), false)")
def sponsor_rate_without_resolves(spark, sf_dir):
    return quality.quality_rates(quality.without_resolves(documents(spark, sf_dir, fields=RATED))).select("sponsor_rate")


@query(HEAD + f"select doc_id, regexp_matches(n2000, {q('(?i)' + P.INITIATIVE)}) as citizen_initiative from heads")
def citizen_initiatives(spark, sf_dir):
    return stripped(spark, sf_dir).select("doc_id", extract.is_citizen_initiative(F.col("t")).alias("citizen_initiative"))


@query(HEAD + "select doc_id, round(least(1::double, least(1::double, length(t) / 5000::double) + (case when contains(t, 'AMENDMENT') then 0.05 else 0 end + case when contains(t, 'SECTION') then 0.05 else 0 end + case when contains(t, 'enacted') then 0.05 else 0 end)::double + (case when " + TITLE_ + " is not null then 0.05 else 0 end)::double), 9) as early_confidence from heads")
def early_confidence(spark, sf_dir):
    d = stripped(spark, sf_dir)
    return d.select("doc_id", F.round(extract.early_confidence(F.col("t"), extract.title(F.col("t"))), 9).alias("early_confidence"))


_LOG = "concat('tests/test_', cast(doc_id as varchar(20)), case doc_id % 3 when 0 then ' PASSED' when 1 then ' FAILED and again FAILED' else ' skipped' end)"


@query(f"select sum(len(regexp_extract_all(line, 'PASSED'))) as n_passed, sum(len(regexp_extract_all(line, 'FAILED'))) as n_failed from (select {_LOG} as line from documents)")
def test_tokens(spark, sf_dir):
    return quality.test_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.expr(_LOG).alias("line")))


@query(
    """with d as (select doc_id, text, strlen(text) % 7 = 0 as bad from documents where text is not null)
select doc_id, case when bad then 'ValueError: broken file' end as error, case when not bad then md5(text || chr(10)) end as pages_md5, case when not bad then md5(text) end as lines_md5 from d"""
)
def decoded_pages(spark, sf_dir):
    def pages_or_error(content: bytes) -> list[str]:
        if len(content) % 7 == 0:
            raise ValueError("broken file")
        return content.decode().split("\n")

    files = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("content"))
    d = readers.decoded(files, pages_or_error)
    text = lambda f: F.md5(f(F.col("pages")).cast("binary"))
    # null where the decoder failed: one pass over the files serves both kinds of rows
    return d.select("doc_id", "error", text(readers.text_of_pages).alias("pages_md5"), text(readers.text_of_page_lines).alias("lines_md5"))


@query(FULL + "select doc_id, cast(json_object('bill_id', bill_id, 'title', title, 'session', session, 'extraction_confidence', extraction_confidence, 'sponsors', sponsors, 'introduced_date', introduced_date, 'committee', committee, 'amended_code_refs', amended_code_refs) as varchar) as json from scored")
def document_json_rows(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", document_json(d, "bill_id", "title", "session", "extraction_confidence", "sponsors", "introduced_date", "committee", "amended_code_refs").alias("json"))


@query(PLAIN + "select doc_id, filename from (select doc_id, filename from bills order by doc_id limit 100) order by md5('0:' || doc_id), doc_id limit 20")
def sample_bills(spark, sf_dir):
    return selection.sample(bills(spark, sf_dir).select("doc_id", "filename"), 20, "doc_id")


@query(
    HEAD
    + f""", l as (select doc_id, {TITLE_} as head, list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip_('x')}), lambda x: not regexp_matches(x, '^[0-9]+$')) as ls from heads),
  r as (select doc_id, head, ls[list_position(list_transform(ls, lambda x: contains(x, 'An Act') or contains(x, 'Resolve')), true) + 1:] as rest from l),
  k as (select *, list_position(list_transform(rest, lambda x: not regexp_matches(x, '^[a-z(–-]') or regexp_matches(x, '^(Reference to|Presented by|Cosponsored)')), true) as stop from r)
  select doc_id, case when head is not null then array_to_string(list_concat([head], case when stop > 0 then rest[1:stop - 1] else rest end), ' ') end as title from k"""
)
def long_titles(spark, sf_dir):
    return documents(spark, sf_dir, "long_titles").select("doc_id", "title")


# ------------------------------------------------------------ changes and versions

_LANDED_ = """, earlier as (select filename, sha256(raw_text) as digest from bills where doc_id % 7 <> 0),
  now as (select filename, sha256(raw_text || case when doc_id % 3 = 0 then ' amended' else '' end) as digest from bills where doc_id % 5 <> 0)"""


def _landings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two scrapes: each lacks some bills of the other, and a third has other texts in the second."""
    b = bills(spark, sf_dir)
    text = F.concat("raw_text", F.when(F.col("doc_id") % 3 == 0, " amended").otherwise(""))
    return b.where("doc_id % 7 <> 0").select("filename", F.sha2("raw_text", 256).alias("digest")), b.where("doc_id % 5 <> 0").select("filename", F.sha2(text, 256).alias("digest"))


@query(PLAIN + _LANDED_ + " select filename, case when t.digest is null then 'insert' when n.digest is null then 'vanish' else 'change' end as action, t.digest as before, n.digest as after from earlier t full join now n using (filename) where t.digest is distinct from n.digest")
def change_table(spark, sf_dir):
    return changes.change_table(*_landings(spark, sf_dir), "filename")


@query(PLAIN + _LANDED_ + " select filename, coalesce(n.digest, t.digest) as digest, case when t.digest is null then 'insert' when n.digest is null then 'vanish' when t.digest = n.digest then 'same' else 'change' end as action from earlier t full join now n using (filename)")
def merged_landings(spark, sf_dir):
    before, now = _landings(spark, sf_dir)
    return changes.merged(before, now, "filename", complete=F.lit(True))


@query(FULL + f", v as (select doc_id, title, bill_id, {found_('t', P.BILL_ID, 0)} as direct_id from docs) select doc_id, title, bill_id, direct_id from v")
def versions_in_sql(spark, sf_dir):
    """Two registered versions, named in SQL."""
    register_views(spark, bills(spark, sf_dir))
    return spark.sql("SELECT s.doc_id, s.title, s.bill_id, d.bill_id AS direct_id FROM bills_standard s JOIN bills_direct_only d ON s.doc_id = d.doc_id")


@query(PLAIN + "select doc_id, filename from bills order by md5('7:' || doc_id), doc_id limit 1")
def sample_one(spark, sf_dir):
    return selection.sample(bills(spark, sf_dir).select("doc_id", "filename"), 1, "doc_id", first=None, seed=7)
