"""The queries op1 to op13 over the whole table `documents`, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, doubling, fingerprint, langid, lines, mixing, ngram_join, phrases, pieces, pii, quality, secrets, suffix
from .common import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its calibrated probability and whether the mixture keeps it."""
    return mixing.mix_to_targets(documents(spark, sf_dir)).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality_rules(documents(spark, sf_dir))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "runner_up", "gap", "ambiguous")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_strings(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_secret", "n_name", "n_address")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.dedup_windows(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first scan of `documents`, each row one version of the path doc_id."""
    found = secrets.scan(documents(spark, sf_dir), secrets.own_ledger(spark))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_source_mixing, op2_fingerprints, op3_quality_rules, op4_language_id, op5_suffix_dedup, op6_sentence_pieces, op7_ngram_jaccard, op8_line_dedup, op9_personal_data, op10_substring_dedup, op11_phrases, op12_secret_scan, op13_source_divergence)}


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_WORD = r"[^\x20\x09-\x0D]+"
_STOPS = _quoted(sorted({x for ws in quality.STOP_WORDS.values() for w in ws for x in (w, w.capitalize())}))
_COUNTS = {
    "n_upper": "length(regexp_replace(t, '[^A-Z]+', '', 'g'))",
    "n_marks": "length(regexp_replace(t, '[^!?]+', '', 'g'))",
    "n_stop": f"len(list_filter(w, lambda x: x in ({_STOPS})))",
    "n_bullets": r"len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·–]')))",
}


def _rules_sql() -> str:
    broken = []
    for r in quality.RULES:
        a, b = quality.RATIOS.get(r.metric, (None, None))
        value = r.metric if a is None else f"(case when {b} > 0 then {a}::double / {b} else 0 end)"
        if r.low is not None:
            broken.append(f"({value} < {r.low} and n_words >= {r.min_words})")
        if r.high is not None:
            broken.append(f"({value} > {r.high} and n_words >= {r.min_words})")
    return " or ".join(broken)


def _spans_sql(kind: str, pattern: str, check: str) -> str:
    """List of {start, stop} of the matches m that pass `check`; matches and the gaps between them alternate."""
    return f"""list_filter(list_transform(range(1, len({kind}_m) + 1), lambda i: {{'a': (list_sum(list_transform({kind}_g[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform({kind}_m[1:i - 1], lambda g: length(g))), 0))::bigint, 'n': length({kind}_m[i]), 'm': {kind}_m[i]}}), lambda s: {check.format("s.m")})"""


def _secrets_sql() -> str:
    check = {"assign": f"length(regexp_replace({{0}}, '^{secrets.ASSIGN}', '')) >= 6".replace("[\\\"']", "[\"'']"), "access": "length({0}) >= 20"}
    pattern = lambda r: r.pattern.replace("[\\\"']", "[\"'']")
    found = ", ".join(f"regexp_extract_all(t, '{pattern(r)}') as {r.kind}_m, regexp_split_to_array(t, '{pattern(r)}') as {r.kind}_g" for r in secrets.RULES)
    lists = ", ".join(f"{_spans_sql(r.kind, r.pattern, check.get(r.kind, 'true'))} as {r.kind}" for r in secrets.RULES)
    told = lambda rules: "array_to_string(list_transform(list_sort(list_concat(" + ", ".join(f"list_transform({r.kind}, lambda s: {{'a': s.a, 'k': {k}, 'v': '{r.kind}:' || s.a || ':' || (s.a + s.n)}})" for k, r in enumerate(rules)) + ")), lambda s: s.v), ',')"
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
f as (select doc_id, {found} from d),
s as (select doc_id, {lists} from f)
select doc_id, len(assign) as n_assign, len(access) as n_access, len(hex) as n_hex, sha256({told(secrets.BASE)}) as base_sha256, {told(secrets.RULES)} as spans from s"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_quality_rules": rf"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l from documents),
win as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d)),
again as (select doc_id, k from win group by all having count(*) > 1),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from win join again using (doc_id, k)) group by 1),
m as (select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, {", ".join(f"{v} as {k}" for k, v in _COUNTS.items())}
  from d left join covered using (doc_id)),
b as (select *, n_words < 10 or n_repeat_words * 100 > n_words * 20 as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({_rules_sql()}) as kept from b""",
    "op5_suffix_dedup": """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
c as (select doc_id, j, substr(h, 2 * j + 1, 1000) as h from (select doc_id, h, unnest(range(0, length(h) // 2 - 99, 401)) as j from d)),
w as (select doc_id, j + i as i, row_number() over (partition by substr(h, 2 * i + 1, 200) order by doc_id, j + i) as r
  from (select doc_id, j, h, unnest(range(0, length(h) // 2 - 99)) as i from c)),
late as (select doc_id, i, coalesce(lag(i) over (partition by doc_id order by i) + 100 >= i, false) as joined from w where r > 1),
n as (select doc_id, i, sum(case when joined then 0 else 1 end) over (partition by doc_id order by i) as k from late),
s as (select doc_id, k, min(i) as a, max(i) + 100 as b from n group by all),
g as (select doc_id, k, a, b, coalesce(lag(b) over (partition by doc_id order by k), 0) as p, lead(a) over (partition by doc_id order by k) is null as final from s),
x as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' order by k) || max(case when final then substr(h, 2 * b + 1) else '' end) as kept from g join d using (doc_id) group by 1)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256 from d left join x using (doc_id)""",
    "op8_line_dedup": """
with l as (select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(s) as line, unnest(range(1, len(s) + 1)) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents))),
h as (select k, max(doc_id) as last from l where length(k) >= 20 group by 1 having count(distinct doc_id) >= 3),
x as (select doc_id, i, line, coalesce(doc_id < last, false) as gone from l left join h using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from x group by 1""",
    "op10_substring_dedup": rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
win as (select doc_id, i, row_number() over (partition by array_to_string(w[i:i + 19], ' ') order by doc_id, i) as r from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d)),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from win where r > 1),
x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
y as (select doc_id, count(*) as n_words, count(g.i) as n_removed, string_agg(word, ' ' order by x.i) filter (g.i is null) as kept from x left join gone g using (doc_id, i) group by 1)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join y using (doc_id)""",
    "op11_phrases": rf"""
with p as (select lang, regexp_extract_all(s, '[^\x20\x09]+') as w from
    (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as s from documents)),
g as materialized (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*)::hugeint as f
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from p, (values (1), (2), (3)) as v(k)) group by all),
n as (select lang, sum(f) as n from g where k = 1 group by 1),
c as materialized (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from g where k > 1 and f >= 10),
parts as materialized (select lang, phrase, k, a, j, array_to_string(w[:j], ' ') as head, array_to_string(w[j + 1:], ' ') as tail from (select *, unnest(range(1, k)) as j from c)),
heads as materialized (select parts.*, f as l from parts left join g on g.lang = parts.lang and g.phrase = head),
cut as (select heads.lang, heads.phrase, heads.k, a, l, f as r, 1000000 * a * a // (l * f) as score, j from heads left join g on g.lang = heads.lang and g.phrase = tail),
low as (select * from cut qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (select lang, phrase, max(a) as longer from (select lang, array_to_string(w[1:2], ' ') as phrase, a from c where k = 3 union all select lang, array_to_string(w[2:3], ' '), a from c where k = 3) group by all),
kept as (select low.* from low left join inside i using (lang, phrase) where low.k = 3 or coalesce(100 * longer < 50 * a, true)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score from ranked join n using (lang) where rank <= 2000""",
    "op12_secret_scan": _secrets_sql(),
    "op13_source_divergence": rf"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
t as (select id, lang, source, unnest(w) as term from d),
vocab as (select lang, term, count(*) as total from t group by all having count(distinct id) >= 10),
v as (select lang, count(*) as v, sum(total)::hugeint as size from vocab group by 1),
groups as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t semi join vocab using (lang, term) group by all),
size as (select lang, source, sum(n)::hugeint as size from c group by all),
cells as (select g.lang, g.source, term, coalesce(n, 0) as n, (1 + 1000000000::hugeint * (coalesce(n, 0) + 2) // (coalesce(s.size, 0) + 2 * v.v))::bigint as p, (1 + 1000000000::hugeint * (total + 2) // (v.size + 2 * v.v))::bigint as q
  from groups g join vocab using (lang) join v using (lang) left join c using (lang, source, term) left join size s using (lang, source)),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value from cells a join cells b using (lang, term) where a.source <> b.source group by all),
everyone as (select g.lang, g.source, h.source as item, coalesce(value, 0)::bigint as value from groups g join groups h on g.lang = h.lang and g.source <> h.source left join pairs p on p.lang = g.lang and p.source = g.source and p.item = h.source)
select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from everyone
union all
select lang, source, 'term', term, (p - q) * (p - q) // (p + q) as value, row_number() over (partition by lang, source order by (p - q) * (p - q) // (p + q) desc, term) as rank from cells where n > 0 and p > q qualify rank <= 10""",
}
