"""One query for each operator of this subpackage, over its whole table, and checks in SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.decontaminate import find_leaks
from postmill.llm.fill_middle import fill_in_middle, restored
from postmill.llm.filter_audit import audit_filters
from postmill.llm.license_scan import Optional, Template, Var, scan_licenses
from postmill.llm.license_templates import PHRASES, TEMPLATES
from postmill.llm.line_dedup import EDIT_WORDS, dedup_lines
from postmill.llm.maxent_lm import score_documents
from postmill.llm.metric_join import link_vectors
from postmill.llm.near_dup import near_duplicates
from postmill.llm.ordinal_quality import grade, rate_documents, train_model
from postmill.llm.packing import pack_documents
from postmill.llm.revisits import resolve_revisits
from postmill.llm.secret_crf import scan_secrets
from postmill.llm.url_filter import FILE_ENDINGS, HOST_WORDS, Rule, judge_urls

TOKENIZER = "word_bpe_49k.json"
SURE_WORDS = 4  # a place of so many mandatory words scores a half
URL_RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return pack_documents(table(spark, folder, "documents"), path).select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_bytes").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "sequence_tokens",
        "padded_tokens",
    )


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), min_words=1, partner_words=EDIT_WORDS - 1)
    count = F.coalesce(F.size("dropped_lines"), F.lit(0)).cast("bigint")
    return found.select("doc_id", F.greatest(count, F.lit(0)).alias("n_dropped"), "text")


def near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("crf").alias("n_crf"),
    )


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return rate_documents(documents, quality_model(spark, documents, folder))


def quality_model(spark: SparkSession, documents: DataFrame, folder: str):
    rated = table(spark, folder, "labels").select(
        "doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")
    )
    return train_model(documents, rated)


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(table(spark, folder, "embeddings"))


# Crawl records that are derived from each page: visits of the page itself, with new answers
# and not-modified ones, and one visit of its host's home page. {} is for the dialect.
_RECORDS = """
select page_id * 8 + k as record_id, page_id, k,
    case when k = 5 then regexp_extract(url, '^[^:]*://[^/?#]*', 0) || '/'
         when k = 4 then upper(substring(url, 1, 8)) || substring(url, 9) || '#again'
         else url end as url,
    1600000000 + (page_id * 7919) % 1000000 + k * 86400 as seconds,
    case when k in (0, 2) or (k = 5 and page_id % 5 = 0) then 'response' else 'revisit' end
        as record_type,
    case when k in (0, 2) or (k = 5 and page_id % 5 = 0) then 200 else 304 end as status,
    case when k = 3 and page_id % 5 = 0 then null
         when k = 4 then 'W/"' || substring(md5(html), 1, 8) || '"'
         when k = 2 then '"' || substring(md5(html || '2'), 1, 8) || '"'
         when k = 5 then '"home' || cast(page_id % 10 as string) || '"'
         else '"' || substring(md5(html), 1, 8) || '"' end as etag,
    case when k = 3 then null else 'day ' || cast(page_id % 3 as string) end as last_modified,
    case when k = 3 and page_id % 2 = 0 then null else md5(html) end as digest
from (select page_id, url, html, {explode} as k from pages) as visits
where not (k = 0 and page_id % 7 = 0) and not (k = 2 and page_id % 3 != 0)
"""


def crawl_records(pages: DataFrame) -> DataFrame:
    made = pages.sparkSession.sql(
        _RECORDS.format(explode="explode(sequence(0, 5))").replace("from pages", "from {pages}"), pages=pages
    )
    headers = F.create_map(
        F.lit("Content-Type"), F.when(F.col("status") == 200, "text/html").otherwise("text/plain"),
        F.lit("ETag"), F.coalesce("etag", F.lit("-")),
        F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.col("k") * 60),
        F.lit("Server"), F.concat(F.lit("s"), F.col("record_id").cast("string")),
    )
    return made.select(
        "record_id", "url", F.timestamp_seconds("seconds").alias("warc_date"), "record_type",
        "status", "etag", "last_modified", "digest", headers.alias("headers"),
    )


def revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = resolve_revisits(crawl_records(table(spark, folder, "pages")))
    pairs = F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(pairs), "; "))


def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(table(spark, folder, "documents"))
    base = F.filter("places", lambda p: p["kind"] == "base")
    starts = F.transform(base, lambda p: p["start"])

    def listed(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    most = F.array_max(F.transform("places", lambda p: p["mandatory"])).cast("double")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.col("places")).alias("labels"),
        F.coalesce(most / (most + SURE_WORDS), F.lit(0.0)).alias("score"),
    )


def fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_in_middle(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_url_filter": url_filter,
    "op2_packing": packing,
    "op3_line_dedup": line_dedup,
    "op4_near_dup": near_dup,
    "op5_decontamination": decontamination,
    "op6_secrets": secrets,
    "op7_language_model": language_model,
    "op8_revisits": revisits,
    "op9_quality": quality,
    "op10_embeddings": embeddings,
    "op11_filter_audit": filter_audit,
    "op12_license_scan": license_scan,
    "op13_fill_in_middle": fill_middle,
}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _unescaped_sql(column: str) -> str:
    """Escapes of visible ASCII signs but ``/ ? #`` are read, then A-Z is in lower case."""
    code = "try_cast('0x' || substring(x, 1, 2) as int)"
    fits = f"regexp_matches(x, '^[2-7][0-9A-Fa-f]') and {code} not in (32, 35, 47, 63, 127)"
    piece = f"case when i = 1 then x when {fits} then chr({code}) || substring(x, 3) else '%' || x end"
    whole = f"array_to_string(list_transform(string_split({column}, '%'), lambda x, i: {piece}), '')"
    return f"translate({whole}, {_LETTERS})"


_URL_SQL = """
with split as (
    select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') as raw,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), named as (
    select page_id, path,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
    from split
), rules(rule, rule_host, rule_path, verdict) as (
    values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
        ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
        ('com/de/', 'com', '/de/', 'block')
), globs(pattern, host_part, path_end) as (
    select '*' || w || '*/', w, '' from (select unnest([{words}]) as w)
    union all select '*/*.' || e, '', '.' || e from (select unnest([{endings}]) as e)
), parted as (
    select page_id, {unescaped_host} as h, string_split({unescaped_path}, '/')[2:] as segments,
        host = '' and path = '' as nothing
    from named
), seen as (
    select page_id, nothing,
        rtrim(regexp_replace(regexp_replace(h, '^(?s).*@', ''), ':(80|443)?$', ''), '.') as host,
        '/' || array_to_string(list_concat(
            list_reduce(list_transform(segments, lambda x: [x]), lambda a, b: case b[1]
                when '.' then a when '..' then a[1:greatest(len(a) - 1, 1)] else list_concat(a, b) end,
                ['']),
            case when segments[-1] in ('.', '..') then [''] else [] end)[2:], '/') as path
    from parted
), fits as (
    select page_id, max_by(struct_pack(rule, verdict), length(rule)) as best
    from named join rules
        on ('.' || host) like ('%.' || rule_host) and starts_with(path, rule_path)
    group by page_id
), judged as (
    select page_id, max_by(pattern, length(pattern)) as pattern
    from seen join globs on not nothing and contains(host, host_part) and ends_with(path, path_end)
    group by page_id
)
select n.page_id, host, path, f.best.rule as rule,
    coalesce(f.best.verdict, case when j.pattern is null then 'allow' else 'block' end) as verdict,
    case when f.best is null then j.pattern end as "glob"
from named n left join fits f using (page_id) left join judged j using (page_id)
""".format(
    words=", ".join(f"'{w}'" for w in HOST_WORDS),
    endings=", ".join(f"'{e}'" for e in FILE_ENDINGS),
    unescaped_host=_unescaped_sql("host"),
    unescaped_path=_unescaped_sql("path"),
)

_CLASSES_SQL = """
, walk as (
    select distinct x as node, x as reached from links
    union
    select w.node, l.y as reached from walk w join links l on w.reached = l.x
), classes as (select node, min(reached) as component from walk group by node)
"""

_NEAR_SQL = (
    """
with recursive words as (
    select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') as w from documents
), shingles as (
    select distinct doc_id, s from (
        select doc_id, unnest(case when len(w) >= 5
            then list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] end) as s from words)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id), links as (
    select x, y from (
        select a.doc_id as x, b.doc_id as y, count(*) as common
        from shingles a join shingles b on a.s = b.s and a.doc_id != b.doc_id group by all
    ) join sizes p on p.doc_id = x join sizes q on q.doc_id = y
    where common >= 0.8 * (p.n + q.n - common)
)"""
    + _CLASSES_SQL
    + """
select doc_id, coalesce(component, doc_id) as class_id, coalesce(component, doc_id) = doc_id as kept
from documents left join classes on node = doc_id
"""
)

_EMBEDDING_SQL = (
    """
with recursive usable as (
    select vec_id, embedding::double[] as v from embeddings
    where len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
        and len(list_filter(embedding, lambda e: e != 0)) > 0
), links as (
    select a.vec_id as x, b.vec_id as y from usable a join usable b
    on a.vec_id != b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95
)"""
    + _CLASSES_SQL
    + """, counted as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, coalesce(component, vec_id) as component_id,
    coalesce(component, vec_id) = vec_id as kept
from embeddings left join classes on node = vec_id left join counted on x = vec_id
"""
)

_REVISIT_SQL = (
    "with records as ("
    + _RECORDS.format(explode="unnest(range(6))")
    + r"""), keyed as (
    select *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url,
            '^[A-Za-z]+://[^/?#]*')), '^http:', 'https:'), '^(https://)www[.]', '\1'),
            ':(80|443)$', '')
        || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            url, '^[A-Za-z]+://[^/?#]*', ''), '#.*$', ''), '([?&])(utm_[^=&]*|ref)=[^&]*', '\1', 'g'),
            '([?&])&+', '\1', 'g'), '[?&]+$', ''), '/$', '') as url_key
    from records
), answers as (
    select url_key, seconds, arg_max(r, r.record_id) as s
    from (select url_key, seconds, struct_pack(record_id, etag, last_modified, digest) as r
        from keyed where record_type = 'response' and status = 200)
    group by url_key, seconds
), met as (
    select r.*, a.s from (select * from keyed where record_type = 'revisit') r
    asof left join answers a on r.url_key = a.url_key and r.seconds > a.seconds
), judged as (
    select *, case when s is null then 'missing'
        when coalesce(
            replace(s.etag, 'W/', '') = replace(etag, 'W/', ''),
            s.last_modified = last_modified, s.digest = digest) is null then 'unchecked'
        when coalesce(
            replace(s.etag, 'W/', '') = replace(etag, 'W/', ''),
            s.last_modified = last_modified, s.digest = digest) then 'resolved'
        else 'changed' end as outcome
    from met
)
select record_id, url_key, s.record_id as response_id, outcome,
    'cache-control=max-age=' || (k * 60) || '; content-type=text/'
        || case when outcome = 'resolved' then 'html' else 'plain' end
        || '; etag=' || coalesce(etag, '-') || '; server=s'
        || case when outcome = 'resolved' then s.record_id else record_id end as headers,
    case when outcome = 'resolved' then s.digest else digest end as digest
from judged
"""
)

_AUDIT_SQL = """
with split as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), firsts as (select t, min(doc_id) as least from split group by t), failed as (
    select s.part, l.good, l.toxic, [
        len(w) < 200,
        100 * len(list_distinct(w)) < 50 * len(w),
        100 * len(regexp_replace(s.t, '[^A-Z]+', '', 'g')) > 2 * len(s.t),
        regexp_matches(s.t, '[#$%&*|]'),
        coalesce(f.least < s.doc_id, false)
    ] as fails
    from split s join firsts f using (t) left join (
        select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic
        from labels group by doc_id) l on l.doc_id = s.doc_id
), counted as (
    select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from failed group by all
), letters as (select unnest(range(1, 6)) as f), orders as (
    select [a.f, b.f, c.f, d.f, e.f] as o
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps as (
    select o, k as step, o[k] as f, o[1:k - 1] as earlier from orders, (select unnest(range(1, 6)) as k)
), judged as (
    select part, o, step, f, n, good, toxic, fails[f] as bad,
        len(list_filter(earlier, lambda x: fails[x])) > 0 as gone,
        len(list_filter(fails, lambda x: x)) = 1 and fails[f] as lone
    from steps, counted
), summed as (
    select part, o, step, f, sum(case when not gone and not bad then n else 0 end) as kept,
        sum(case when bad and not gone then n else 0 end) as removed,
        sum(case when bad and gone then n else 0 end) as redundant,
        sum(case when lone then n else 0 end) as unique_fails,
        sum(case when bad and not gone then good else 0 end) as good_lost,
        sum(case when bad and not gone then toxic else 0 end) as toxic_lost
    from judged group by part, o, step, f
)
select part, array_to_string(list_transform(o, lambda x: chr(64 + x::int)), '') as filter_order,
    step::int as step, kept::bigint as kept, removed::bigint as removed,
    redundant::bigint as redundant, unique_fails::bigint as unique_fails,
    good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, f))::bigint as shapley
from summed
"""


def _as_pattern(parts: tuple) -> str:
    """A template as a pattern over words with a blank after each."""
    done = []
    for part in parts:
        if isinstance(part, Var):
            done.append(f"(?:[^ ]+ ){{{part.low},{part.high}}}")
        elif isinstance(part, Optional):
            done.append(f"(?:{_as_pattern(part.parts)})?")
        else:
            done.append(part + " ")
    return "".join(done)


def _license_sql() -> str:
    labels, sizes, starts = [], [], []
    for phrase, label in PHRASES.items():
        n = len(phrase.split())
        found = f"list_filter(range(len(w) - {n - 1}), lambda i: w[i + 1:i + {n}] = string_split('{phrase}', ' '))"
        starts.append(found)
        labels.append(f"case when len({found}) > 0 then '{label}' end")
        sizes.append(f"case when len({found}) > 0 then {n} end")
    base = f"[{', '.join(labels)}]"
    for label, markup in TEMPLATES:
        template = Template(label, markup)
        fits = f"regexp_matches(line, ' {_as_pattern(template.parts)}')"
        labels.append(f"case when {fits} then '{label}' end")
        sizes.append(f"case when {fits} then {template.mandatory} end")

    def listed(values: str) -> str:
        return f"array_to_string(list_sort(list_distinct({values})), ',')"

    return f"""
with split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), lined as (select *, ' ' || array_to_string(w, ' ') || ' ' as line from split), found as (
    select doc_id, len(w) as n_words, flatten([{", ".join(starts)}]) as starts,
        {base} as base, [{", ".join(labels)}] as labels, list_max([{", ".join(sizes)}])::double as most
    from lined
)
select doc_id, n_words, len(starts) as n_base, list_min(starts) as first_word,
    list_max(starts) as last_word, {listed("base")} as base_labels, {listed("labels")} as labels,
    coalesce(most / (most + {SURE_WORDS}), 0) as score
from found
"""


_MIDDLE_SQL = """
with drawn as (
    select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w
    from documents
), numbers as (
    select *, len(w) as n, list_transform(range(4), lambda k:
        list_reduce(list_transform(range(8), lambda d:
            (instr('0123456789abcdef', substring(h, (8 * k + d + 1)::int, 1)) - 1)::bigint),
            lambda a, b: a * 16 + b)) as x
    from drawn
), cut as (
    select *, least(x[1] % (n + 1), x[2] % (n + 1)) as a, greatest(x[1] % (n + 1), x[2] % (n + 1)) as b,
        case when x is null or t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
            or x[3] % 100 >= 90 then 'plain' when x[4] % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, array_to_string(w[1:a], '') as p, array_to_string(w[a + 1:b], '') as m,
        array_to_string(w[b + 1:], '') as s
    from cut
)
select doc_id, n, form, case when form != 'plain' then len(p) end as prefix_chars,
    case when form != 'plain' then len(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
from parts
"""

ORACLE = {
    "op1_url_filter": _URL_SQL,
    "op4_near_dup": _NEAR_SQL,
    "op8_revisits": _REVISIT_SQL,
    "op10_embeddings": _EMBEDDING_SQL,
    "op11_filter_audit": _AUDIT_SQL,
    "op12_license_scan": _license_sql(),
    "op13_fill_in_middle": _MIDDLE_SQL,
}
