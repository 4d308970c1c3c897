"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions.chat import render_chat, render_prompt, with_reply
from postmill.functions.cleaning import (
    extract_urls,
    hard_cut,
    normalize_whitespace,
    remove_signature,
    strip_quoted_history,
    truncate_thread,
)
from postmill.functions.html import html_to_text
from postmill.functions.replies import parse_task_reply
from postmill.functions.prompts import (
    chat_teacher_messages,
    correction,
    output_budget,
    summary_messages,
    task_error,
)
from postmill.functions.summary import coerce_summary, is_lenient_summary, is_strict_summary
from postmill.operators.cleaning import accepted, clean_emails, clean_records, quarantined
from postmill.operators.inference import chat_requests, model_teacher
from postmill.operators.labelling import (
    LENIENT_TEACHER,
    SERVING,
    STRICT_TEACHER,
    LabelPolicy,
    chat_examples,
    label_requests,
    label_stats,
)
from postmill.operators.search import build_index, semantic_search
from postmill.operators.routing import multitask_mix, route_requests, serve_requests
from postmill.operators.shaping import batch_plan, cap_items, cap_sequences, length_batches, sample_items
from postmill.plans import fixtures
from postmill.plans.stub_teacher import StubClient
from postmill.session import shared_dir
from postmill.sources.jsonl import (
    read_chat_examples,
    read_clean_emails,
    write_chat_examples,
    write_clean_emails,
)
from postmill.sources.labelled import read_labelled
from postmill.sources.mail_source import read_mail_files, write_mail_files
from postmill.sources.maildir import is_mail_name
from postmill.sources.mime import body_text, parse_mails
from postmill.sources.parts import attachment_names, with_parts
from postmill.sources.texts import nonblank_bodies
from postmill.streaming.incremental import start_email_stream
from postmill.streaming.versions import mail_versions

CAP = 500
NEAREST = 10
QUERY_EVERY = 50
SAMPLE_FRACTION = 0.25
SKIP_EVERY = 11


def _on_body(step):
    """A query that applies one cleaning step to the bodies."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        body = F.coalesce("body", F.lit(""))
        return fixtures.emails(spark, folder).select("doc_id", step(body).alias("text"))

    return query


def _flat(urls: Column) -> Column:
    return F.array_join(urls, " ").alias("urls")


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_emails(fixtures.emails(spark, folder))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder).select(
        "doc_id",
        F.coalesce("subject", F.lit("")).alias("subject"),
        "clean_text",
        _flat(F.col("urls")),
    )


def urls(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_urls(F.coalesce("body", F.lit("")))
    return fixtures.emails(spark, folder).select("doc_id", F.explode(found).alias("url"))


def hard_cuts(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder).select("doc_id", hard_cut(F.col("clean_text")).alias("text"))


def html(spark: SparkSession, folder: str) -> DataFrame:
    pages = fixtures.table(spark, folder, "pages").select("page_id", "html")
    return pages.select("page_id", html_to_text(F.col("html")).alias("text"))


def preferred_body(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_mails(fixtures.raw_pages(spark, folder))
    return parsed.select(
        F.col("path").cast("bigint").alias("page_id"),
        "body_kind",
        body_text(F.col("body_kind"), F.col("body")).alias("body"),
        "error",
    )


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    return parse_mails(fixtures.raw_mails(spark, folder).where(is_mail_name(F.col("path"))))


def mail_scan(spark: SparkSession, folder: str) -> DataFrame:
    records = accepted(clean_records(_scanned(spark, folder)))
    return records.select("source", "path", "subject", "clean_text", _flat(F.col("urls")))


def mail_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of mails with attachments."""
    parts = with_parts(fixtures.attachment_mails(spark, folder))
    return parts.select(
        F.col("path").cast("bigint").alias("doc_id"), F.col("part_no").cast("bigint").alias("part_no"),
        "content_type", "file_name", "is_attachment", "size", "error",
    )


def prompt_attachment(spark: SparkSession, folder: str) -> DataFrame:
    """The attachment task's prompt, with the names that the mails themselves have."""
    named = attachment_names(fixtures.attachment_mails(spark, folder))
    requests = named.select(
        F.col("path").cast("bigint").alias("doc_id"), F.lit("attachment").alias("task"),
        F.lit("files").alias("subject"), F.concat(F.lit("see "), "path").alias("body"), "attachments",
    )
    routed = route_requests(requests)
    return routed.select("doc_id", *_contents(F.col("messages"), "system", "user"))


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return quarantined(_scanned(spark, folder))


def mail_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as mail files and read back, clean ones and failures."""
    root = shared_dir(spark, "mailbox")
    raw = fixtures.raw_mails(spark, folder).unionByName(fixtures.empty_mails(spark, folder))
    lost = write_mail_files(raw, root).where("error is not null")
    if not lost.isEmpty():
        raise OSError(lost.first().error)
    records = clean_records(read_mail_files(spark, root))
    path = F.regexp_replace("path", "^.*?(?=/mail/)", "")
    return records.select(
        path.alias("path"), "subject", "clean_text", _flat(F.col("urls")), "error"
    )


def nonblank(spark: SparkSession, folder: str) -> DataFrame:
    bodies = fixtures.documents(spark, folder, "text").selectExpr(
        "doc_id", f"{fixtures.BLANKABLE} as body"
    )
    return nonblank_bodies(bodies)


def clean_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "clean")
    records = _cleaned(spark, folder).select(
        F.lit("documents").alias("source"),
        F.col("doc_id").cast("string").alias("path"),
        "subject",
        "clean_text",
        "urls",
    )
    write_clean_emails(records, path)
    back = read_clean_emails(spark, path)
    return back.select("source", "path", "subject", "clean_text", _flat(F.col("urls")))


def _draft_flag(check):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return fixtures.drafts(spark, folder).select("doc_id", check(F.col("draft")).alias("valid"))

    return query


def coerce(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.drafts(spark, folder).select(
        "doc_id", coerce_summary(F.col("draft")).alias("summary")
    )


def _contents(messages: Column, *names: str) -> list[Column]:
    return [messages[i]["content"].alias(name) for i, name in enumerate(names)]


def prompt_summarize(spark: SparkSession, folder: str) -> DataFrame:
    messages = summary_messages(F.col("subject"), F.col("clean_text"))
    return _cleaned(spark, folder).select("doc_id", *_contents(messages, "system", "user"))


def prompt_summarize_b(spark: SparkSession, folder: str) -> DataFrame:
    messages = chat_teacher_messages(F.col("subject"), hard_cut(F.col("clean_text")))
    return _cleaned(spark, folder).select("doc_id", *_contents(messages, "system", "user"))


def prompt_multitask(spark: SparkSession, folder: str) -> DataFrame:
    routed = route_requests(fixtures.requests(spark, folder))
    return routed.where(F.col("route_error").isNull()).select(
        "doc_id", "task", *_contents(F.col("messages"), "system", "user")
    )


def task_router_valid(spark: SparkSession, folder: str) -> DataFrame:
    error = task_error(F.col("task"))
    return fixtures.requests(spark, folder).select(
        "doc_id", "task", error.isNull().alias("valid"), error.alias("error")
    )


def token_budget(spark: SparkSession, folder: str) -> DataFrame:
    routed = fixtures.requests(spark, folder).where(task_error(F.col("task")).isNull())
    budget = output_budget(F.col("task")).cast("bigint")
    return routed.select("doc_id", "task", budget.alias("max_new_tokens"))


def prompt_correction(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.drafts(spark, folder)
    first = summary_messages(F.col("subject"), F.coalesce("body", F.lit("")))
    columns = []
    for style in ("serving", "teacher", "chat"):
        retry = correction(first, F.col("draft"), style)
        text = F.array_join(
            F.transform(retry, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n"
        )
        columns.append(text.alias(style))
    return rows.select("doc_id", *columns)


def _labels(
    spark: SparkSession, folder: str, policy: LabelPolicy, fail_every: int = 0
) -> DataFrame:
    mails = _cleaned(spark, folder)
    if policy is LENIENT_TEACHER:
        messages = chat_teacher_messages(F.col("subject"), hard_cut(F.col("clean_text")))
    else:
        messages = summary_messages(F.col("subject"), F.col("clean_text"))
    requests = chat_requests(mails.withColumn("messages", messages), "doc_id")
    teacher = model_teacher(
        lambda: StubClient(fail_every), on_error="skip" if fail_every else "fail"
    )
    return label_requests(requests, teacher, policy)


def _label_flow(policy: LabelPolicy, fail_every: int = 0):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _labels(spark, folder, policy, fail_every).select(
            F.col("id").alias("doc_id"),
            "label",
            "status",
            F.col("attempts").cast("bigint").alias("attempts"),
            "error",
        )

    return query


def stats(spark: SparkSession, folder: str) -> DataFrame:
    counts = label_stats(_labels(spark, folder, LENIENT_TEACHER, SKIP_EVERY))
    return counts.withColumn("attempts", F.col("attempts").cast("bigint"))


def examples(spark: SparkSession, folder: str) -> DataFrame:
    done = chat_examples(_labels(spark, folder, STRICT_TEACHER))
    return done.select(
        F.col("id").alias("doc_id"), *_contents(F.col("messages"), "system", "user", "assistant")
    )


def _example_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Chat examples of all mails and their drafts, without a model in between."""
    rows = clean_emails(fixtures.drafts(spark, folder))
    prompt = summary_messages(F.col("subject"), F.col("clean_text"))
    return rows.select(
        "doc_id", prompt.alias("prompt"), with_reply(prompt, F.col("draft")).alias("messages")
    )


def chat_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "examples")
    write_chat_examples(_example_rows(spark, folder), path)
    back = read_chat_examples(spark, path)
    return back.select(*_contents(F.col("messages"), "system", "user", "assistant"))


def labelled_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Records of three shapes, read back as chat messages and their other keys."""
    path = shared_dir(spark, "labelled")
    fixtures.labelled_lines(spark, folder).write.text(path)
    rows = read_labelled(spark, path)
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return rows.select(said.alias("said"), "extra", "error")


def kept_count(spark: SparkSession, folder: str) -> DataFrame:
    """Chat examples of the drafts that pass, over a former output of all: the sink's own count,
    and what is read back."""
    path = shared_dir(spark, "kept")
    rows = clean_emails(fixtures.drafts(spark, folder))
    prompt = summary_messages(F.col("subject"), F.col("clean_text"))
    made = rows.select("draft", with_reply(prompt, F.col("draft")).alias("messages"))
    every = write_chat_examples(made, path)
    kept = write_chat_examples(made.where(is_lenient_summary(F.col("draft"))), path)
    return read_chat_examples(spark, path).agg(
        F.lit(every).cast("bigint").alias("every"),
        F.lit(kept).cast("bigint").alias("kept"),
        F.count("*").alias("read_back"),
    )


def chat_render(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.conversations(spark, folder).select(
        "conv_id", render_chat(F.col("messages")).alias("text")
    )


def chat_render_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.conversations(spark, folder).select(
        "conv_id", render_prompt(F.col("messages")).alias("text")
    )


def seq_cap(spark: SparkSession, folder: str) -> DataFrame:
    capped = cap_sequences(chat_render(spark, folder))
    return capped.select("conv_id", "n_tokens", F.array_join("tokens", " ").alias("text"))


def batches(spark: SparkSession, folder: str) -> DataFrame:
    counted = cap_sequences(chat_render(spark, folder))
    lengths = counted.select("conv_id", F.size("tokens").alias("length"))
    return length_batches(lengths, "conv_id", "length").withColumnRenamed("id", "conv_id")


def plan(spark: SparkSession, folder: str) -> DataFrame:
    return batch_plan(fixtures.conversations(spark, folder))


def sample(spark: SparkSession, folder: str) -> DataFrame:
    documents = fixtures.table(spark, folder, "documents")
    return sample_items(documents, SAMPLE_FRACTION, "doc_id").select("doc_id")


def multitask(spark: SparkSession, folder: str) -> DataFrame:
    mixed = route_requests(multitask_mix(fixtures.requests(spark, folder)))
    return mixed.select("doc_id", "task", *_contents(F.col("messages"), "system", "user"))


def task_replies(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of a made-up reply to every request."""
    rows = fixtures.requests(spark, folder).withColumn("reply", F.expr(fixtures.REPLY))
    parsed = parse_task_reply(F.col("task"), F.col("reply"), F.col("categories"))
    return rows.select("doc_id", "task", parsed.alias("p")).select("doc_id", "task", "p.*")


def cap(spark: SparkSession, folder: str) -> DataFrame:
    first = cap_items(fixtures.table(spark, folder, "documents"), CAP, "doc_id")
    return clean_emails(
        first.selectExpr("doc_id", f"{fixtures.SUBJECT} as subject", f"{fixtures.BODY} as body")
    ).select("doc_id", "clean_text")


def task_serving(spark: SparkSession, folder: str) -> DataFrame:
    answers = serve_requests(
        fixtures.requests(spark, folder), model_teacher(StubClient), id_column="doc_id"
    )
    return answers.select(
        F.col("id").alias("doc_id"),
        "label",
        "status",
        F.col("attempts").cast("bigint").alias("attempts"),
        "error",
    )


def search(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest other vectors to every 50th, over all vectors."""
    vectors = fixtures.table(spark, folder, "embeddings").select("vec_id", "embedding")
    index = build_index(vectors, None, "vec_id", "embedding")
    queries = vectors.where(F.col("vec_id") % QUERY_EVERY == 0)
    return semantic_search(index, queries, NEAREST, "vec_id", "embedding", exclude_same_id=True)


def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaner over a stream of the documents, read back from what the stream wrote."""
    target = shared_dir(spark, "stream")
    schema = fixtures.table(spark, folder, "documents").select("doc_id", "text").schema
    stream = (
        # A pattern, because a stream's plain path must be a folder and the table may be a file.
        spark.readStream.schema(schema)
        .parquet(f"{folder}/documents[.]parquet")
        .selectExpr("doc_id", f"{fixtures.SUBJECT} as subject", f"{fixtures.BODY} as body")
    )
    start_email_stream(stream, "doc_id", f"{target}/out", f"{target}/state").awaitTermination()
    written = "doc_id bigint, clean_text string, urls array<string>"
    back = spark.read.schema(written).json(f"{target}/out")
    return back.select("doc_id", "clean_text", _flat(F.col("urls")))


def stream_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Four runs of one stream over the documents as mails: all; repeats and changes; repeats two
    days later; repeats of forgotten and of known ones, and late ones."""
    target = shared_dir(spark, "versions")
    documents = fixtures.documents(spark, folder, "text").where("doc_id is not null")
    kinds = "id string, at timestamp, text string"
    for run in fixtures.ARRIVALS:
        for where, seconds, text in run:
            arrived = documents.where(where).selectExpr(
                "cast(doc_id as string) as id", f"timestamp_seconds({seconds}) as at", f"{text} as text"
            )
            arrived.write.mode("append").parquet(f"{target}/in")
        stream = spark.readStream.schema(kinds).parquet(f"{target}/in")
        found = mail_versions(stream, "id", "at", ["text"])
        writer = found.writeStream.format("parquet").option("path", f"{target}/out")
        writer = writer.option("checkpointLocation", f"{target}/state").trigger(availableNow=True)
        writer.start().awaitTermination()
    return spark.read.parquet(f"{target}/out").select(
        F.col("id").cast("bigint").alias("doc_id"),
        F.unix_seconds("at").alias("seconds"),
        F.md5("text").alias("text_md5"),
        F.col("version").cast("bigint").alias("version"),
        "kind",
    )


QUERIES = {
    "clean_emails": clean,
    "html_to_text": html,
    "strip_quoted_history": _on_body(strip_quoted_history),
    "remove_signature": _on_body(remove_signature),
    "normalize_whitespace": _on_body(normalize_whitespace),
    "extract_urls": urls,
    "truncate_thread": _on_body(truncate_thread),
    "hard_cut": hard_cuts,
    "nonblank_bodies": nonblank,
    "mail_scan": mail_scan,
    "mail_files": mail_files,
    "mail_parts": mail_parts,
    "prompt_attachment": prompt_attachment,
    "preferred_body": preferred_body,
    "quarantine": quarantine,
    "clean_jsonl_roundtrip": clean_jsonl_roundtrip,
    "chat_jsonl_roundtrip": chat_jsonl_roundtrip,
    "kept_count": kept_count,
    "labelled_variants": labelled_variants,
    "summary_strict": _draft_flag(is_strict_summary),
    "summary_lenient": _draft_flag(is_lenient_summary),
    "summary_coerce": coerce,
    "prompt_summarize": prompt_summarize,
    "prompt_summarize_b": prompt_summarize_b,
    "prompt_multitask": prompt_multitask,
    "prompt_correction": prompt_correction,
    "token_budget": token_budget,
    "task_router_valid": task_router_valid,
    "label_flow_strict": _label_flow(STRICT_TEACHER),
    "label_flow_lenient": _label_flow(LENIENT_TEACHER, SKIP_EVERY),
    "label_flow_coerce": _label_flow(SERVING),
    "label_stats": stats,
    "chat_examples": examples,
    "chat_render": chat_render,
    "chat_render_prompt": chat_render_prompt,
    "seq_cap": seq_cap,
    "length_batches": batches,
    "batch_plan": plan,
    "cap_items": cap,
    "sample_items": sample,
    "multitask_mix": multitask,
    "task_replies": task_replies,
    "semantic_search": search,
    "task_serving": task_serving,
    "stream_clean_emails": stream_clean,
    "stream_mail_versions": stream_versions,
}
