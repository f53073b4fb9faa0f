"""Model replies: request tables, detected datasets and merged metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import once, shuffled
from metaloom.functions.geo import box_from_columns
from metaloom.functions.prompts import detection_prompt, generation_prompt
from metaloom.functions.text import (
    DEFAULT_WAIT_SECONDS,
    failure_reason,
    file_name,
    is_quota_error,
    retry_delay,
    with_reply_json,
)
from metaloom.functions.normalise import normalise_text
from metaloom.functions.variants import any_text, array_at, child, has_key, kind, strict_json
from metaloom.operators.validation import check_documents


def parse_replies(replies: DataFrame, reply: str = "response") -> DataFrame:
    """Add `text`, `kind` (object, array, text) and `v`, the parsed value of the text."""
    return with_reply_json(replies, reply)


def _dataset_array() -> Column:
    """The datasets of a parsed reply: a `datasets` list, a bare list, or one object.

    A reply without JSON, or with a bare scalar, counts as one dataset without fields.
    """
    v = F.col("v")
    listed = array_at(v, "$.datasets")
    nothing = F.array(F.lit(None).cast("variant"))
    return (
        F.when(kind(v) == "OBJECT", F.coalesce(listed, F.array(v)))
        .when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
        .otherwise(nothing)
    )


#: What an unreadable reply is reported as.
NO_JSON = "no JSON in the reply"


def detected_datasets(
    replies: DataFrame, key: str, site: Column, site_url: Column, reply: str = "response"
) -> DataFrame:
    """One row per detected dataset: key, j (from 1) of n, dataset, name and url with their defaults.

    A default applies only where the key is missing; a null or empty value stays. A reply without JSON stays one row
    without a dataset, and keeps its text as `raw_response` and why it gave nothing as `error`; both are null elsewhere.
    """
    parsed = parse_replies(replies, reply)
    unread = (F.col("kind") == "text") & F.col("v").isNull()
    rows = (
        parsed.withColumn("raw_response", F.when(unread, F.col(reply)))
        .withColumn("error", F.when(unread, F.lit(NO_JSON)))
        .withColumn("_site", site)
        .withColumn("_site_url", site_url)
        .select(key, "_site", "_site_url", "raw_response", "error", _dataset_array().alias("_datasets"))
    )
    rows = (
        once(rows, _found=F.col("_datasets"))
        .select(
            key,
            "_site",
            "_site_url",
            "raw_response",
            "error",
            F.size("_found").alias("n"),
            F.posexplode("_found").alias("_i", "dataset"),
        )
        .withColumn("j", F.col("_i") + 1)
    )
    dataset = F.col("dataset")
    return rows.select(
        key,
        "j",
        "n",
        "dataset",
        F.when(has_key(dataset, "$.name"), any_text(child(dataset, "$.name")))
        .otherwise(F.concat("_site", F.lit("_dataset_"), F.col("j").cast("string")))
        .alias("name"),
        F.when(has_key(dataset, "$.url"), any_text(child(dataset, "$.url")))
        .otherwise(F.col("_site_url"))
        .alias("url"),
        "raw_response",
        "error",
    )


def dataset_counts(detected: DataFrame, key: str) -> DataFrame:
    return detected.groupBy(key).agg(F.count("*").alias("n_datasets"))


def merge_metadata(detected: DataFrame, registry: DataFrame, key: str, row_key: str) -> DataFrame:
    """Metadata of each detected dataset: the detected value where its key is present, else the registry's."""
    site_columns = [
        "description",
        "grp",
        "creator",
        "provider",
        "publisher",
        "keywords",
        "box_lon_min",
        "box_lat_min",
        "box_lon_max",
        "box_lat_max",
    ]
    sites = registry.select(
        F.col(row_key).alias("_row"),
        *[
            (
                F.coalesce(F.col(c), F.lit("")) if c in registry.columns else F.lit("")
            ).alias(f"_{c}")
            for c in site_columns
        ],
    )
    dataset = F.col("dataset")
    # What the reply says is read before the join; the parsed reply comes along only if it is asked for.
    fields = ["description", "creator", "publisher", "keywords", "spatialCoverage"]
    said = detected.select(
        key,
        "j",
        "name",
        "url",
        *[has_key(dataset, f"$.{f}").alias(f"_has_{f}") for f in fields],
        *[any_text(child(dataset, f"$.{f}")).alias(f"_said_{f}") for f in fields],
        dataset.alias("extracted"),
        *[c for c in ("raw_response", "error") if c in detected.columns],
    )
    joined = said.join(sites, F.col(key) == F.col("_row"), "left")

    def preferred(field: str, fallback: Column) -> Column:
        return F.when(F.col(f"_has_{field}"), F.col(f"_said_{field}")).otherwise(
            F.coalesce(fallback, F.lit(""))
        )

    box = box_from_columns(*[F.col(f"_{c}") for c in site_columns[-4:]])
    return joined.select(
        key,
        "j",
        "name",
        "url",
        preferred("description", F.col("_description")).alias("description"),
        F.coalesce("_grp", F.lit("")).alias("grp"),
        preferred("creator", F.col("_creator")).alias("creator"),
        F.coalesce("_provider", F.lit("")).alias("provider"),
        preferred("publisher", F.col("_publisher")).alias("publisher"),
        preferred("keywords", F.col("_keywords")).alias("keywords"),
        preferred("spatialCoverage", box).alias("spatial_coverage"),
        "extracted",
        *[c for c in ("raw_response", "error") if c in detected.columns],
    )


def with_source_facts(merged: DataFrame, facts: DataFrame, url: str = "url") -> DataFrame:
    """Add the facts of each dataset's own page, NULL where the page was not captured.

    `facts` has `url` (unique) and `facts`, the JSON of `pages.facts_json`.
    """
    known = facts.select(F.col("url").alias("_url"), F.col("facts").alias("source_facts"))
    return merged.join(shuffled(known), F.col(url) == F.col("_url"), "left").drop("_url")


def detection_requests(sites: DataFrame, template: str, text: str = "text") -> DataFrame:
    """The request table of the detection step: row_id, url and prompt.

    Replies come back as a table with `row_id` and `response`; `detected_datasets` reads it.
    """
    return sites.select(
        "row_id",
        F.trim("webpage_url").alias("url"),
        detection_prompt(
            template,
            F.trim("webpage_url"),
            F.col(text),
            F.col("name"),
            F.col("grp"),
            F.coalesce("description", F.lit("")) if "description" in sites.columns else F.lit(""),
        ).alias("prompt"),
    )


def generation_requests(merged: DataFrame, template: str, key: str, example: Column) -> DataFrame:
    """The request table of the generation step: key, j and prompt."""
    names = [
        "name",
        "url",
        "description",
        "creator",
        "provider",
        "publisher",
        "keywords",
        "spatial_coverage",
    ]
    metadata = {n: F.col(n) for n in names} | {"group": F.col("grp")}
    given = F.to_json("extracted")
    extracted = F.coalesce(given, F.lit("{}"))
    if "source_facts" in merged.columns:
        # The facts become one more key at the end of the detected object; anything else is wrapped in one first.
        is_object = F.startswith(extracted, F.lit("{"))
        extracted = F.when(is_object, extracted).otherwise(F.concat(F.lit('{"dataset":'), extracted, F.lit("}")))
        inside = F.regexp_replace(extracted, r"\}$", "")
        comma = F.when(inside == "{", F.lit("")).otherwise(F.lit(","))
        extracted = F.concat(
            inside, comma, F.lit('"source_facts":'), F.coalesce("source_facts", F.lit("{}")), F.lit("}")
        )
    return merged.select(
        key, "j", generation_prompt(template, metadata, extracted, example).alias("prompt")
    )


def request_ledger(requests: DataFrame, attempts: DataFrame, key: str, most: int = 3) -> DataFrame:
    """What became of each request: key, status (done, due, given_up), n_attempts, due_at, response, reason.

    `attempts` are events: key, `at` (seconds), `response` and `message`, null where there was no error. The first
    reply without an error is the accepted one, so a repeated reply changes nothing. A failure of a kind that passes by
    (quota, timeout, server) is due again after its wait, at most `most` attempts in all; any other ends the request. Requests
    without attempts are due at once. Attempts are partial aggregates, so a request tried very often meets as few rows.
    """
    message = F.col("message")
    failed = message.isNotNull()
    quota = is_quota_error(message)
    reason = F.when(quota, F.lit("quota")).otherwise(failure_reason(message))
    passing = quota | reason.isin("timeout", "server_error")
    wait = F.when(quota, retry_delay(message)).otherwise(F.lit(DEFAULT_WAIT_SECONDS))
    last = F.struct("at", reason.alias("reason"), passing.alias("passing"), (F.col("at") + wait).alias("due_at"))
    tried = attempts.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.min(F.when(~failed, F.struct("at", "response"))).alias("_reply"),
        F.max(F.when(failed, last)).alias("_last"),
    )
    done = F.col("_reply").isNotNull()
    ended = (F.col("n_attempts") >= most) | ~F.col("_last")["passing"]
    status = F.when(done, F.lit("done")).when(F.coalesce(ended, F.lit(False)), F.lit("given_up")).otherwise(F.lit("due"))
    joined = requests.select(key).join(shuffled(tried), F.col(key) == F.col("_key"), "left")
    return joined.select(
        key,
        status.alias("status"),
        F.coalesce("n_attempts", F.lit(0)).cast("long").alias("n_attempts"),
        F.when(status == "due", F.coalesce(F.col("_last")["due_at"], F.lit(0.0))).alias("due_at"),
        F.col("_reply")["response"].alias("response"),
        F.when(~done, F.col("_last")["reason"]).alias("reason"),
    )


def generated_documents(
    replies: DataFrame, comment: str, site: str = "site", url: str = "site_url", reply: str = "response"
) -> DataFrame:
    """Replies of the generation step as documents: `replies` with document, filename, ok, errors, message and reason.

    The reply's object is repaired and checked as any document is; its file is named by its `name`, else by the site. A reply
    that holds no object, and a document that fails a check, have a `message` and its failure class, so both
    the files to write and the failure report are filters of this one table.
    """
    parsed = parse_replies(replies, reply).withColumnRenamed("text", "_said")
    is_object = F.col("kind") == "object"
    repaired = once(parsed.drop("v"), document=normalise_text(F.when(is_object, F.col("_said")), comment))
    read = once(repaired, v=strict_json(F.col("document")))
    checked = check_documents(read, "document")
    name = F.coalesce(any_text(child(F.col("v"), "$.name")), F.col(site))
    nothing = F.when(F.col("kind") == "text", F.lit(NO_JSON)).otherwise(F.lit("the reply is no object"))
    message = F.when(~is_object, nothing).when(~F.col("ok"), F.array_join("errors", "; "))
    out = checked.withColumn("filename", F.when(is_object, file_name(name, F.col(url)))).withColumn("message", message)
    reason = F.when(F.col("message").isNotNull(), failure_reason(F.col("message"), "generation"))
    return out.withColumn("ok", is_object & F.col("ok")).withColumn("reason", reason).drop("_said", "v", "warnings", "messages")
