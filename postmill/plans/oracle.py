"""The registered queries in DuckDB SQL, for checking.

They follow the line-by-line definition of each step with lists of lines, where the
Spark side uses one expression per text, so the two have little in common to be
wrong about together.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from postmill import fixed_values as fixed
from postmill.functions.summary import PREFIXES
from postmill.operators.routing import BLANK_ERROR
from postmill.operators.shaping import CHUNK_BATCHES
from postmill.plans import fixtures, queries, stub_teacher

NL = "chr(10)"
# Whitespace as a list of code points, not by category as on the Spark side.
WS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
LINE_BREAK = r"\r\n|[\x{0a}-\x{0d}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+\z', '', 'g')"


def lines(x: str) -> str:
    body = rf"regexp_replace({x}, '(?:{LINE_BREAK})\z', '')"
    return f"(case when {x} = '' then [] else string_split_regex({body}, '{LINE_BREAK}') end)"


def joined(x: str) -> str:
    return strip(f"coalesce(array_to_string({x}, {NL}), '')")


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def truncated(x: str) -> str:
    n = fixed.BODY_LIMIT
    head = rf"regexp_replace(substring({x}, 1, {n}), ' [^ ]*\z', '')"
    return f"case when length({x}) <= {n} then {x} else {head} || '{fixed.CUT_MARK}' end"


def url_list(x: str) -> str:
    found = f"regexp_extract_all({x}, '(?i)https?://[^{WS}]+')"
    return f"list_sort(list_distinct(list_transform({found}, lambda u: rtrim(u, '.,)'))))"


def filled(template: str, **values: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(values[p] if i % 2 else quote(p) for i, p in enumerate(parts) if p)


# Steps over a CTE: each takes the name of a relation with a text column and gives the
# CTEs that add the step's result as another column.

_QUOTE = (
    f"(?i)(?:{fixed.QUOTE_INTRO_START}.*{fixed.QUOTE_INTRO_END}"
    + "".join(f"|{label}:[{WS}].*" for label in fixed.QUOTE_HEADER_LABELS)
    + f"|{fixed.QUOTE_TITLE})"
)


def quotes_cut(source: str, column: str, to: str, name: str) -> str:
    hit = f"regexp_full_match({strip('l')}, {quote(_QUOTE)})"
    return f"""
{name}_a as (select *, {lines(column)} as {name}_l from {source}),
{name}_b as (select *, list_min(list_transform({name}_l, lambda l, i: case when {hit} then i end))
  as {name}_i from {name}_a),
{name} as (select * exclude ({name}_l, {name}_i),
  {joined(f'{name}_l[1 : coalesce({name}_i - 1, len({name}_l))]')} as {to} from {name}_b)"""


def signature_cut(source: str, column: str, to: str, name: str) -> str:
    hit = " or ".join(f"starts_with({strip('l')}, {quote(m)})" for m in fixed.SIGNATURE_MARKERS)
    return f"""
{name}_s as (select *, {strip(column)} as {name}_t from {source}),
{name}_a as (select *, {lines(f'{name}_t')} as {name}_l from {name}_s),
{name}_b as (select *, list_max(list_transform({name}_l, lambda l, i: case when {hit} then i end))
  as {name}_i from {name}_a),
{name} as (select * exclude ({name}_t, {name}_l, {name}_i),
  {joined(f'{name}_l[1 : coalesce({name}_i - 1, len({name}_l))]')} as {to} from {name}_b)"""


def cleaned(source: str, name: str = "c", subject: str = "subject") -> str:
    """CTEs from ``subject, body`` to ``clean_text`` and ``urls``."""
    return f"""
{name}0 as (select *, coalesce(body, '') as {name}_body from {source}),
{quotes_cut(f'{name}0', f'{name}_body', f'{name}_t1', f'{name}1')},
{signature_cut(f'{name}1', f'{name}_t1', f'{name}_t2', f'{name}2')},
{name}3 as (select *, {collapse(f'{name}_t2')} as {name}_t3, {url_list(f'{name}_t2')} as url_list
  from {name}2),
{name}4 as (select *, {truncated(f'{name}_t3')} as {name}_t4 from {name}3),
{name} as (select *, array_to_string(url_list, ' ') as urls,
  case when length({subject}) > 0 then 'Subject: ' || {subject} || {NL} || {name}_t4
    else {name}_t4 end as clean_text from {name}4)"""


EMAILS = f"e as (select *, {fixtures.SUBJECT} as subject, {fixtures.BODY} as body from documents)"
CLEAN = f"with {EMAILS}, {cleaned('e')}"
DRAFTS = f"{EMAILS}, d as (select *, {fixtures.DRAFT} as draft from e)"


def content_lines(x: str) -> str:
    return f"list_filter({lines(strip(x))}, lambda l: {strip('l')} <> '')"


def strict(lines_column: str) -> str:
    tests = [
        f"starts_with({lines_column}[{i}], {quote(p)})" for i, p in enumerate(PREFIXES, 1)
    ]
    return f"coalesce(len({lines_column}) = 5 and {' and '.join(tests)}, false)"


def lenient(lines_column: str) -> str:
    labels = "|".join(fixed.SUMMARY_LABELS)
    pattern = quote(rf"(?i)^[{WS}]*\p{{Nd}}\)[{WS}]*(?:{labels}):[{WS}]*.+")
    tests = [f"regexp_matches({strip(f'{lines_column}[{i}]')}, {pattern})" for i in range(1, 6)]
    return f"coalesce(len({lines_column}) = 5 and {' and '.join(tests)}, false)"


def coerced(lines_column: str) -> str:
    parts = []
    for i, prefix in enumerate(PREFIXES, 1):
        line = strip(f"{lines_column}[{i}]")
        parts.append(
            f"case when len({lines_column}) < {i} then {quote(f'{prefix} {fixed.MISSING_VALUE}')} "
            f"when starts_with({line}, {quote(prefix)}) then {line} "
            f"else {quote(prefix + ' ')} || {line} end"
        )
    return f" || {NL} || ".join(parts)


SUBJECT_OR_DEFAULT = f"coalesce(nullif(subject, ''), {quote(fixed.DEFAULT_SUBJECT)})"
SUMMARY_USER = filled(fixed.SUMMARY_USER, subject=SUBJECT_OR_DEFAULT, body="clean_text")
CHAT_USER = filled(
    fixed.CHAT_TEACHER_USER,
    subject=strip("coalesce(subject, '')"),
    body=f"substring(clean_text, 1, {fixed.BODY_LIMIT})",
)
SUMMARY_SYSTEM = quote(fixed.SUMMARY_SYSTEM)
CHAT_SYSTEM = quote(fixed.CHAT_TEACHER_SYSTEM)


def _stub_reply(replies: tuple[str, ...]) -> str:
    cases = [
        f"when {i} then replace({quote(r)}, '{{n}}', cast(n as varchar))"
        for i, r in enumerate(replies)
    ]
    return f"case n % {len(replies)} {' '.join(cases)} end"


def labelled(source: str, user: str, valid, coerce: bool, fail_every: int = 0) -> str:
    """CTEs from a relation with an optional ``free_form`` flag to the label table ``lab``."""
    failing = f"n % {fail_every} = 0" if fail_every else "false"
    given_up = coerced("l2") if coerce else "null"
    return f"""
p as (select *, length({user}) as n, {user} as user_text from {source}),
r as (select *, {_stub_reply(stub_teacher.FIRST)} as r1, {_stub_reply(stub_teacher.RETRY)} as r2,
  {failing} as failed from p),
rl as (select *, {content_lines('r1')} as l1, {content_lines('r2')} as l2 from r),
rv as (select *, {valid('l1')} or free_form as ok1, {valid('l2')} as ok2 from rl),
lab as (select *,
  case when failed then null when ok1 then r1 when ok2 then r2 else {given_up} end as label,
  case when failed then 'failed' when ok1 or ok2 then 'accepted'
    else '{'coerced' if coerce else 'dropped'}' end as status,
  cast(case when failed or ok1 then 1 else 2 end as bigint) as attempts,
  case when failed then 'RuntimeError: no reply to ' || cast(n as varchar) end as error from rv)"""


MARKED = "f as (select *, false as free_form from c)"
STRICT_LABELS = f"{CLEAN}, {MARKED}, {labelled('f', SUMMARY_USER, strict, False)}"
LENIENT_LABELS = (
    f"{CLEAN}, {MARKED}, {labelled('f', CHAT_USER, lenient, False, queries.SKIP_EVERY)}"
)
COERCED_LABELS = f"{CLEAN}, {MARKED}, {labelled('f', SUMMARY_USER, strict, True)}"
LABEL_COLUMNS = "doc_id, label, status, attempts, error"

# Chat examples of the mails with a strictly valid draft.
EXAMPLES = f"""with {DRAFTS}, {cleaned('d')},
x as (select doc_id, {SUMMARY_SYSTEM} as system, {SUMMARY_USER} as user_text, draft from c)"""

CONVERSATIONS = f"""with rendered as (select conv_id, string_agg('<|im_start|>' || coalesce(role, '')
    || {NL} || coalesce(text, '') || '<|im_end|>' || {NL}, '' order by turn, role, text) as text
  from conversations group by conv_id),
words as (select conv_id, string_split_regex({strip('text')}, '[{WS}]+') as w from rendered)"""

REQUESTS = f"""q as (select *, {fixtures.TASK} as task, {fixtures.SUBJECT} as subject,
  {fixtures.BODY} as body,
  coalesce({fixtures.TONE}, '{fixed.DEFAULT_TONE}') as tone,
  coalesce({fixtures.STYLE}, '{fixed.DEFAULT_STYLE}') as style,
  coalesce({fixtures.LENGTH}, '{fixed.DEFAULT_LENGTH}') as length_word,
  case when doc_id % 2 = 0 then 'Billing, Finance'
    else {quote(', '.join(fixed.DEFAULT_CATEGORIES))} end as categories,
  case when doc_id % 2 = 0 then 'report' || cast(doc_id as varchar) || '.pdf, a.xlsx'
    else {quote(fixed.NO_ATTACHMENTS)} end as attachments from documents)"""


def _reply_field(*names: str) -> str:
    """What follows the first colon of the first line that has one of the names before it; a reply
    has only those of its own task."""
    blanks = "' ' || chr(9)"
    before = f"lower(trim(substring(l, 1, strpos(l, ':') - 1), {blanks}))"
    listed = ", ".join(map(quote, names))
    fitting = f"list_filter(string_split(reply, {NL}), lambda l: strpos(l, ':') > 0 and {before} in ({listed}))"
    after = f"list_transform({fitting}, lambda l: rtrim(ltrim(substring(l, strpos(l, ':') + 1), {blanks}), ' '))"
    return f"nullif({after}[1], '')"


KNOWN_TASKS = ", ".join(quote(t) for t in fixed.TASKS)


def task_user(body: str) -> str:
    texts = {"summarize": fixed.SUMMARY_USER, **fixed.TASK_USER}
    values = {
        "subject": SUBJECT_OR_DEFAULT,
        "body": body,
        "tone": "tone",
        "style": "style",
        "length": "length_word",
        "categories": "categories",
        "attachments": "attachments",
    }
    cases = [f"when {quote(t)} then {filled(texts[t], **values)}" for t in fixed.TASKS]
    return f"case lower(task) {' '.join(cases)} end"


def task_system() -> str:
    texts = {"summarize": fixed.SUMMARY_SYSTEM, **fixed.TASK_SYSTEM}
    return f"case lower(task) {' '.join(f'when {quote(t)} then {quote(texts[t])}' for t in fixed.TASKS)} end"


TASK_ERROR = f"""case when lower(task) in ({KNOWN_TASKS}) then null
  when lower(task) = 'search' then {quote(fixed.SEARCH_ERROR)}
  else 'unknown task: ' || lower(task) end"""


def decoded(x: str) -> str:
    names = ", ".join(f"{quote(n)}: chr({c})" for n, c in sorted(name2codepoint.items()))
    number = "regexp_extract(s, '^#([0-9]+)', 1)"
    hexed = "regexp_extract(s, '^#[xX]([0-9a-fA-F]+)', 1)"
    code = f"coalesce(try_cast({number} as bigint), try_cast('0x' || {hexed} as bigint))"
    fits = (
        f"({code} in (9, 10, 13) or {code} between 32 and 55295 "
        f"or {code} between 57344 and 65533 or {code} between 65536 and 1114111)"
    )
    # The code points that windows-1252 has for 128 to 159, without the five it lacks.
    points = (
        0x20AC, 0x201A, 0x0192, 0x201E, 0x2026, 0x2020, 0x2021, 0x02C6, 0x2030, 0x0160, 0x2039, 0x0152, 0x017D,
        0x2018, 0x2019, 0x201C, 0x201D, 0x2022, 0x2013, 0x2014, 0x02DC, 0x2122, 0x0161, 0x203A, 0x0153, 0x017E, 0x0178,
    )
    western = ", ".join(str(c) for c in range(128, 160) if c not in (129, 141, 143, 144, 157))
    signs = ", ".join(f"chr({c})" for c in points)
    named = f"(map {{{names}}})[regexp_extract(s, '^([a-zA-Z][a-zA-Z0-9]*);', 1)]"
    piece = f"""case when i = 1 then s
      when {named} is not null then {named} || regexp_replace(s, '^[^;]*;', '')
      when regexp_matches(s, '^#(?:[0-9]|[xX][0-9a-fA-F])')
        then (case when {code} between 128 and 159 and list_contains([{western}], {code})
            then [{signs}][list_position([{western}], {code})]
            when {fits} then chr(cast({code} as int)) else '' end)
          || regexp_replace(s, '^#(?:[0-9]+|[xX][0-9a-fA-F]+);?', '')
      else '&' || s end"""
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda s, i: {piece}), '')"


# A page is walked construct by construct: what opens at the next "<", then to its end. Each
# step gives a piece of text, or a mark where markup stood.
MARK = "chr(64976)"


def _step(pos: str, mode: str, name: str = "''", piece: str = "''") -> str:
    return f"struct_pack(pos := {pos}, mode := {mode}, name := {name}, piece := {piece})"


def _to_end(found: str, after: str) -> str:
    """``after`` if ``found``, else the end of the page."""
    return f"case when {found} = 0 then pos + length(s) else {after} end"


_TEXT_STEP = f"""case when strpos(s, '<') = 0 then {_step("pos + length(s)", "'done'", piece="s")}
  else {_step("pos + strpos(s, '<') - 1", "'open'", piece="substring(s, 1, strpos(s, '<') - 1)")} end"""
_COMMENT_END = "strpos(substring(s, 5), '-->')"
_OPEN_STEP = f"""case
  when starts_with(s, '<!--') then {_step(_to_end(_COMMENT_END, f"pos + 6 + {_COMMENT_END}"), "'text'", piece=MARK)}
  when regexp_matches(s, '(?i)^<(script|style|template|rt|rp)\\b') then {_step(
      "pos + 1 + length(regexp_extract(s, '^<([A-Za-z]+)', 1))", "'tag'", "lower(regexp_extract(s, '^<([A-Za-z]+)', 1))")}
  when regexp_matches(s, '^</?[A-Za-z]') then {_step("pos + length(regexp_extract(s, '^</?[A-Za-z]'))", "'tag'")}
  when starts_with(s, '<!') or starts_with(s, '<?')
    then {_step(_to_end("strpos(s, '>')", "pos + strpos(s, '>')"), "'text'", piece=MARK)}
  else {_step("pos + 1", "'text'", piece="'<'")} end"""
# In a tag: an equals sign with a quoted value behind it, another equals sign, or the end.
_VALUE = "ltrim(substring(s, strpos(s, '=') + 1), ' ' || chr(9) || chr(10) || chr(13) || chr(12))"
_VALUE_END = f"strpos(substring({_VALUE}, 2), substring({_VALUE}, 1, 1))"
_TAG_STEP = f"""case
  when strpos(s, '=') > 0 and (strpos(s, '>') = 0 or strpos(s, '=') < strpos(s, '>')) then
    case when substring({_VALUE}, 1, 1) in ('"', chr(39)) and {_VALUE_END} > 0
      then {_step(f"pos + length(s) - length({_VALUE}) + 1 + {_VALUE_END}", "'tag'", "name")}
      else {_step("pos + strpos(s, '=')", "'tag'", "name")} end
  else {_step(_to_end("strpos(s, '>')", "pos + strpos(s, '>')"),
              "case when name = '' then 'text' when name in ('rt', 'rp') then 'ruby' else 'unread' end", "name", MARK)} end"""
_LOW = "translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CLOSE = f"strpos({_LOW}, '</' || name)"
_UNREAD_STEP = f"""case when {_CLOSE} = 0 then {_step("pos + length(s)", "'text'")}
  when regexp_matches(substring(s, {_CLOSE} + 2 + length(name), 1), '[A-Za-z0-9_]')
    then {_step(f"pos + {_CLOSE}", "'unread'", "name")}
  else {_step(_to_end(f"strpos(substring(s, {_CLOSE}), '>')", f"pos + {_CLOSE} - 1 + strpos(substring(s, {_CLOSE}), '>')"),
              "'text'", piece=MARK)} end"""
_RUBY_STEP = f"""case when strpos(s, '<') = 0 then {_step("pos + length(s)", "'text'")}
  when regexp_matches(substring(s, strpos(s, '<')), '(?i)^</?(rt|rp|ruby)\\b')
    then {_step("pos + strpos(s, '<') - 1", "'open'")}
  else {_step("pos + strpos(s, '<')", "'ruby'", "name")} end"""

#: CTEs (of a recursive WITH) that end in ``page_texts``: page_id, url and the text of the page.
PAGE_TEXTS = f"""
numbered as (select row_number() over () as r, page_id, url, coalesce(html, '') as h from pages),
walk as (
  select r, 0 as n, {_step("cast(1 as bigint)", "'text'")} as state from numbered
  union all
  select r, n + 1, case mode when 'text' then {_TEXT_STEP} when 'open' then {_OPEN_STEP}
    when 'tag' then {_TAG_STEP} when 'unread' then {_UNREAD_STEP} else {_RUBY_STEP} end
  from (select w.r, w.n, w.state.pos as pos, w.state.mode as mode, w.state.name as name, substring(p.h, w.state.pos) as s
    from walk w join numbered p on w.r = p.r where w.state.mode <> 'done')
),
glued as (select r, string_agg(state.piece, '' order by n) as t from walk group by r),
page_texts as (select page_id, url, {decoded(
    f"array_to_string(list_filter(string_split(t, {MARK}), lambda x: x <> ''), ' ')")} as text
  from numbered join glued using (r))"""


# What parsing must give for the mail shapes of the fixtures, by variant number.
SHAPE = f"% {fixtures.MAIL_SHAPES}"
MAILBOX = f"""{EMAILS}, m0 as (select doc_id, {fixtures.MAIL_PATH} as path,
  coalesce(subject, '') as subject, coalesce(body, '') as text, doc_id {SHAPE} as shape from e),
m as (select path, subject, case when shape = 8 then '' else text end as body,
  shape = 9 and text <> '' as failed from m0 where not regexp_matches(path, '/\\.[^/]*$'))"""


def _cut_query(step) -> str:
    base = f"with {EMAILS}, b as (select doc_id, coalesce(body, '') as body from e)"
    return f"{base}, {step('b', 'body', 'text', 's')} select doc_id, text from s"


def _scalar_query(expression: str) -> str:
    return (
        f"with {EMAILS}, b as (select doc_id, coalesce(body, '') as body from e) "
        f"select doc_id, {expression} as text from b"
    )


def _correction(*turns: tuple[str, str]) -> str:
    return f" || {NL} || ".join(f"'{role}: ' || {text}" for role, text in turns)


_FIRST = (("system", SUMMARY_SYSTEM), ("user", "user_text"))

ORACLE = {
    "clean_emails": f"{CLEAN} select doc_id, coalesce(subject, '') as subject, clean_text, urls from c",
    "html_to_text": f"with recursive {PAGE_TEXTS} select page_id, text from page_texts",
    "strip_quoted_history": _cut_query(quotes_cut),
    "remove_signature": _cut_query(signature_cut),
    "normalize_whitespace": _scalar_query(collapse("body")),
    "extract_urls": f"""with {EMAILS}
        select doc_id, unnest({url_list("coalesce(body, '')")}) as url from e""",
    "truncate_thread": _scalar_query(truncated("body")),
    "hard_cut": f"{CLEAN} select doc_id, substring(clean_text, 1, {fixed.BODY_LIMIT}) as text from c",
    "nonblank_bodies": f"""with b as (select doc_id, {strip(f'({fixtures.BLANKABLE})')} as body
        from documents) select doc_id, body from b where body <> ''""",
    "mail_scan": f"""with {MAILBOX}, {cleaned('m')}
        select '{fixed.CORPUS_NAME}' as source, path, subject, clean_text, urls
        from c where not failed""",
    "mail_files": f"""with {MAILBOX}, {cleaned('m')}
        select path, case when failed then '' else subject end as subject,
          case when failed then '' else clean_text end as clean_text,
          case when failed then '' else urls end as urls,
          case when failed then 'TypeError: the body is binary' end as error from c
        union all select {fixtures.EMPTY_PATH}, '', '', '', null from documents
        where doc_id % {fixtures.EMPTY_EVERY} = 0""",
    "mail_parts": """with k as (select doc_id, coalesce(text, '') as text from documents where doc_id is not null)
        select doc_id, cast(0 as bigint) as part_no, 'text/plain' as content_type, cast(null as varchar) as file_name,
          false as is_attachment, strlen('see ' || doc_id) as size, cast(null as varchar) as error from k
        union all select doc_id, 1, 'application/pdf', 'report' || doc_id || '.pdf', true, strlen(text), null
          from k where doc_id % 4 in (1, 2)
        union all select doc_id, 2, 'text/csv', 'na\u00efve ' || doc_id || '.csv', true, strlen(text), null
          from k where doc_id % 4 = 2
        union all select doc_id, 1, 'text/plain', 'odd.txt', true, strlen(text),
          'LookupError: unknown encoding: no-such-set' from k where doc_id % 4 = 3""",
    "prompt_attachment": f"""with q as (select doc_id, 'attachment' as task, 'files' as subject,
          'see ' || doc_id as body, '{fixed.DEFAULT_TONE}' as tone, '{fixed.DEFAULT_STYLE}' as style,
          '{fixed.DEFAULT_LENGTH}' as length_word, {quote(', '.join(fixed.DEFAULT_CATEGORIES))} as categories,
          case doc_id % 4 when 0 then {quote(fixed.NO_ATTACHMENTS)} when 1 then 'report' || doc_id || '.pdf'
            when 2 then 'report' || doc_id || '.pdf, na\u00efve ' || doc_id || '.csv' else 'odd.txt' end as attachments
          from documents where doc_id is not null)
        select doc_id, {task_system()} as system, {task_user("body")} as "user" from q""",
    "preferred_body": f"""with recursive {PAGE_TEXTS}, p as (select *, page_id {SHAPE} as shape from page_texts)
        select page_id,
          case when shape in (3, 4, 5, 6) then 'html' when shape <> 9 then 'plain' end as body_kind,
          case when shape in (3, 4, 5, 6) then text when shape = 8 then ''
            when shape <> 9 then url end as body,
          case when shape = 9 then 'TypeError: the body is binary' end as error from p""",
    "quarantine": f"""with {MAILBOX}
        select path, 'TypeError: the body is binary' as error from m where failed""",
    "clean_jsonl_roundtrip": f"""{CLEAN} select 'documents' as source,
        cast(doc_id as varchar) as path, subject, clean_text, urls from c""",
    "chat_jsonl_roundtrip": f"{EXAMPLES} select system, user_text as \"user\", draft as assistant from x",
    "labelled_variants": f"""select
          case when doc_id % 3 = 2 then 'system: x' || {NL} else '' end
            || 'user: ' || coalesce(text, '') || {NL} || 'assistant: ' || source as said,
          case doc_id % 3 when 0 then '{{"id":' || doc_id || ',"meta":{{"from":"' || source
            || '","lang":"' || lang || '"}}}}' when 1 then '{{"id":' || doc_id || '}}' end as extra,
          cast(null as varchar) as error
        from documents where doc_id is not null and source is not null and lang is not null""",
    "kept_count": f"""with {DRAFTS}, l as (select {content_lines('draft')} as ls from d)
        select count(*) as every, count(*) filter ({lenient('ls')}) as kept,
          count(*) filter ({lenient('ls')}) as read_back from l""",
    "summary_strict": f"""with {DRAFTS}, l as (select doc_id, {content_lines('draft')} as ls from d)
        select doc_id, {strict('ls')} as valid from l""",
    "summary_lenient": f"""with {DRAFTS}, l as (select doc_id, {content_lines('draft')} as ls from d)
        select doc_id, {lenient('ls')} as valid from l""",
    "summary_coerce": f"""with {DRAFTS}, l as (select doc_id, {content_lines('draft')} as ls from d)
        select doc_id, {coerced('ls')} as summary from l""",
    "prompt_summarize": f"""{CLEAN}
        select doc_id, {SUMMARY_SYSTEM} as system, {SUMMARY_USER} as "user" from c""",
    "prompt_summarize_b": f"""{CLEAN}
        select doc_id, {CHAT_SYSTEM} as system, {CHAT_USER} as "user" from c""",
    "prompt_multitask": f"""with {REQUESTS} select doc_id, task, {task_system()} as system,
        {task_user("coalesce(body, '')")} as "user" from q where lower(task) in ({KNOWN_TASKS})""",
    "prompt_correction": f"""with {DRAFTS}, u as (select *,
        {filled(fixed.SUMMARY_USER, subject=SUBJECT_OR_DEFAULT, body="coalesce(body, '')")}
          as user_text from d)
        select doc_id,
          {_correction(*_FIRST, ('user', quote(fixed.SERVING_CORRECTION)))} as serving,
          {_correction(*_FIRST, ('user', quote(fixed.TEACHER_CORRECTION)))} as teacher,
          {_correction(*_FIRST, ('assistant', 'draft'),
                       ('user', quote(fixed.CHAT_TEACHER_CORRECTION)))} as chat from u""",
    "token_budget": f"""with {REQUESTS} select doc_id, task,
        cast(case when lower(task) in ('summarize', 'reply', 'rewrite') then {fixed.LONG_BUDGET}
          else {fixed.SHORT_BUDGET} end as bigint) as max_new_tokens
        from q where lower(task) in ({KNOWN_TASKS})""",
    "task_router_valid": f"""with {REQUESTS} select doc_id, task,
        lower(task) in ({KNOWN_TASKS}) as valid, {TASK_ERROR} as error from q""",
    "label_flow_strict": f"{STRICT_LABELS} select {LABEL_COLUMNS} from lab",
    "label_flow_lenient": f"{LENIENT_LABELS} select {LABEL_COLUMNS} from lab",
    "label_flow_coerce": f"{COERCED_LABELS} select {LABEL_COLUMNS} from lab",
    "label_stats": f"""{LENIENT_LABELS}
        select status, attempts, count(*) as n from lab group by status, attempts""",
    "chat_examples": f"""{STRICT_LABELS} select doc_id, {SUMMARY_SYSTEM} as system,
        user_text as "user", label as assistant from lab where label is not null""",
    "chat_render": f"{CONVERSATIONS} select conv_id, text from rendered",
    "chat_render_prompt": f"""{CONVERSATIONS} select conv_id,
        text || '<|im_start|>assistant' || {NL} as text from rendered""",
    "seq_cap": f"""{CONVERSATIONS} select conv_id, cast(len(w) as bigint) as n_tokens,
        array_to_string(w[1:{fixed.SEQUENCE_LIMIT}], ' ') as text from words""",
    "length_batches": f"""{CONVERSATIONS},
        o as (select conv_id, least(len(w), {fixed.SEQUENCE_LIMIT}) as length, row_number() over (
          order by md5('{fixed.SEED}:' || cast(conv_id as varchar)), conv_id) - 1 as position
          from words),
        k as (select *, position // ({CHUNK_BATCHES} * 16) as chunk from o),
        a as (select *, row_number() over (
          partition by chunk order by length desc, position) - 1 as nth from k)
        select conv_id, length, position, chunk * {CHUNK_BATCHES} + nth // 16 as batch,
          nth % 16 as slot from a""",
    "batch_plan": """with n as (select count(distinct conv_id) as examples from conversations)
        select examples, (examples + 15) // 16 as steps_per_epoch,
          (examples + 15) // 16 * 2 as total_steps from n""",
    "sample_items": f"""select doc_id from documents
        where substring(md5('{fixed.SEED}:' || doc_id), 1, 8) < '{int(queries.SAMPLE_FRACTION * 2**32):08x}'""",
    "multitask_mix": f"""with {REQUESTS}, m as (
          select * exclude (task), unnest([{KNOWN_TASKS}]) as task from q)
        select doc_id, task, {task_system()} as system,
        {task_user("coalesce(body, '')")} as "user" from m""",
    "task_replies": f"""with {REQUESTS}, r as (select *, {fixtures.REPLY} as reply from q),
        f as (select doc_id, task, lower(task) as name, lower(categories) as allowed,
          {_reply_field('label', 'category', 'summary')} as answer, {_reply_field('reason', 'checks')} as detail
          from r)
        select doc_id, task,
          case when name in ('phishing', 'spam', 'categorize', 'attachment') then answer end as answer,
          case when name in ('phishing', 'spam', 'categorize', 'attachment') then detail end as detail,
          case when name in ('phishing', 'spam', 'categorize', 'attachment') then coalesce(
            answer is not null and detail is not null and case name
              when 'phishing' then lower(answer) in ('phishing', 'benign')
              when 'spam' then lower(answer) in ('spam', 'ham')
              when 'categorize' then list_contains(string_split(allowed, ', '), lower(answer))
              else true end, false) end as valid from f""",
    "cap_items": f"{CLEAN} select doc_id, clean_text from c order by doc_id limit {queries.CAP}",
    "semantic_search": f"""with v as (select vec_id as id, embedding::double[] as v from embeddings
          where vec_id is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
            and len(list_filter(embedding, lambda e: e <> 0)) > 0),
        s as (select q.id as query_id, v.id, round(list_cosine_similarity(q.v, v.v), 9) as similarity
          from v q join v on q.id <> v.id and len(q.v) = len(v.v) where q.id % {queries.QUERY_EVERY} = 0)
        select query_id, cast(row_number() over o as int) as rank, id, similarity from s
        window o as (partition by query_id order by similarity desc, id)
        qualify row_number() over o <= {queries.NEAREST}""",
    "task_serving": f"""with {REQUESTS},
        nb as (select * exclude (body), {strip("coalesce(body, '')")} as body from q),
        sent as (select * from nb where body <> '' and lower(task) in ({KNOWN_TASKS})),
        {cleaned('sent', subject="''")},
        f as (select *, lower(task) <> 'summarize' as free_form from c),
        {labelled('f', task_user('clean_text'), strict, True)}
        select {LABEL_COLUMNS} from lab
        union all
        select doc_id, null, 'rejected', 0,
          case when body = '' then '{BLANK_ERROR}' else {TASK_ERROR} end from nb
        where body = '' or lower(task) not in ({KNOWN_TASKS})""",
    # A day's repeats are known, those of two days later too, as nothing has moved the stream's
    # time on before them; after them all others are forgotten.
    "stream_mail_versions": """with k as (select doc_id, text from documents where doc_id is not null)
        select doc_id, 1700000000 + doc_id % 1000 as seconds, md5(text) as text_md5, cast(1 as bigint) as version,
          'new' as kind from k
        union all select doc_id, 1700001000 + doc_id % 10, md5(text || ' v2'), 2, 'changed' from k
          where doc_id % 5 = 0 and text is not null
        union all select doc_id, 1700172860, md5(text), 1, 'new' from k
          where doc_id % 11 = 0 and doc_id % 7 <> 0""",
    "stream_clean_emails": f"{CLEAN} select doc_id, clean_text, urls from c",
}
