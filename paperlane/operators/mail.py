"""Mailbox scan as set-wise DataFrame operators (A3-A5, C4-C6, C9, C10, C13,
D3, D7, E3, E4, E6, H17, H18, B2).

Messages: ``(id, subject, from_name, from_address, received_at,
has_attachments)`` (or the nested ``from.emailAddress`` form, see
:func:`flatten_sender`). Attachments: ``(message_id, att_id, name,
content_type, size, is_inline, ...)``. All messages are handled in one plan;
nothing loops per message on the driver.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from paperlane import vocab
from paperlane.functions import naming as nm


def _ts(df: DataFrame, col: str, value: dt.datetime) -> Column:
    dtype = df.schema[col].dataType
    target = "timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp"
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(target)


def flatten_sender(nested: DataFrame) -> DataFrame:
    """Nested mail-server rows -> flat message rows (dotted-path access)."""
    return nested.select(
        "id", "subject",
        F.col("from.emailAddress.name").alias("from_name"),
        F.col("from.emailAddress.address").alias("from_address"),
        F.col("receivedDateTime").alias("received_at"),
        F.col("hasAttachments").alias("has_attachments"),
    )


def message_window_predicate(messages: DataFrame, lookback_hours: float, as_of: dt.datetime) -> Column:
    """C4: received since ``as_of - lookback`` truncated to whole seconds, with attachments."""
    since = (as_of - dt.timedelta(hours=float(lookback_hours))).replace(microsecond=0)
    return (F.col("received_at") >= _ts(messages, "received_at", since)) & F.col("has_attachments")


def scan_messages(messages: DataFrame, lookback_hours: float, as_of: dt.datetime) -> DataFrame:
    """A3 / F1: messages in the window, projected, newest first (all pages, no limit)."""
    return (messages.where(message_window_predicate(messages, lookback_hours, as_of))
            .select("id", "subject", "from_name", "from_address", "received_at", "has_attachments")
            .orderBy(F.col("received_at").desc(), F.col("id").desc()))


def usable_attachment_predicate(apply_allow_list: bool = False) -> Column:
    """C5 (+ optional C6): drop inline, deny-listed image types and tiny files.

    Missing ``is_inline`` counts as False, missing ``size`` as 0, missing
    content type as ''.
    """
    mime = nm.normalize_mime(F.col("content_type"))
    pred = (~F.coalesce(F.col("is_inline"), F.lit(False))
            & ~mime.isin(*vocab.SKIP_ATTACHMENT_TYPES)
            & (F.coalesce(F.col("size"), F.lit(0)) >= vocab.MIN_ATTACHMENT_SIZE))
    if apply_allow_list:
        pred = pred & mime.isin(*vocab.SUPPORTED_ATTACHMENT_TYPES)
    return pred


def usable_attachments(attachments: DataFrame, apply_allow_list: bool = False) -> DataFrame:
    return attachments.where(usable_attachment_predicate(apply_allow_list))


def scan_attachments(messages: DataFrame, attachments: DataFrame, apply_allow_list: bool = False) -> DataFrame:
    """A4 / D3: usable attachments of the given messages (one equi-join for all
    messages; AQE chooses broadcast or sort-merge and splits skewed keys)."""
    ids = messages.select(F.col("id").alias("message_id"))
    return usable_attachments(attachments, apply_allow_list).join(ids, "message_id", "left_semi")


def message_attachments(messages: DataFrame, attachments: DataFrame) -> DataFrame:
    """D3: the 1:N expansion message -> usable attachments with header columns."""
    m = with_sender_defaults(messages)
    return usable_attachments(attachments).join(
        m.select(F.col("id").alias("message_id"), "subject", "sender_email", "sender_name"), "message_id", "inner")


def decode_payload(b64_col) -> Column:
    """A5: base64 -> bytes; a missing payload is empty bytes."""
    c = F.col(b64_col) if isinstance(b64_col, str) else b64_col
    return F.unbase64(F.coalesce(c, F.lit("")))


def with_sender_defaults(messages: DataFrame) -> DataFrame:
    """Sender name defaults to the address's local part; subject to
    ``(no subject)``."""
    addr = F.coalesce(F.col("from_address"), F.lit(""))
    return messages.withColumns({
        "subject": F.coalesce(F.col("subject"), F.lit(vocab.NO_SUBJECT)),
        "sender_email": addr,
        "sender_name": F.coalesce(F.col("from_name"), F.split_part(addr, F.lit("@"), F.lit(1))),
    })


def attachment_filename(name_col="name", id_col="att_id") -> Column:
    """``attachment_<id>`` when the attachment has no name."""
    n = F.col(name_col) if isinstance(name_col, str) else name_col
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(n, F.concat(F.lit("attachment_"), i))


def messages_with_usable_attachments(messages: DataFrame, attachments: DataFrame) -> DataFrame:
    """A message without usable attachments yields no result."""
    return messages.join(usable_attachments(attachments).select(F.col("message_id").alias("id")), "id", "left_semi")


def message_rollup(outcomes: DataFrame, key: str = "message_id", valid_col: str = "is_valid") -> DataFrame:
    """valid/invalid counts and the all-valid / all-invalid flags per message.

    Plain sums: partial aggregation on the map side keeps a message with a
    huge share of attachments from reaching the shuffle as raw rows.
    """
    v = F.col(valid_col)
    return (outcomes.groupBy(key).agg(
        F.sum(F.when(v, 1).otherwise(0)).cast("bigint").alias("valid_count"),
        F.sum(F.when(v, 0).otherwise(1)).cast("bigint").alias("invalid_count"))
        .withColumns({
            "all_valid": (F.col("valid_count") + F.col("invalid_count") > 0) & (F.col("invalid_count") == 0),
            "all_invalid": (F.col("valid_count") + F.col("invalid_count") > 0) & (F.col("valid_count") == 0),
        }))


def scan_summary(window_messages: DataFrame, outcomes: DataFrame, valid_col: str = "is_valid") -> DataFrame:
    """One row of counters for a scan.

    ``messages_scanned`` counts every message in the window;
    ``messages_with_attachments`` counts those with at least one outcome row.
    Both inputs are tagged and unioned, then reduced by one global aggregate
    (partial per task, one final row): no join of the two totals.
    """
    id_type = outcomes.schema["message_id"].dataType  # message ids are often text
    m = window_messages.select(F.lit(True).alias("_is_msg"), F.lit(None).cast(id_type).alias("_mid"),
                               F.lit(None).cast("boolean").alias("_v"))
    o = outcomes.select(F.lit(False).alias("_is_msg"), F.col("message_id").alias("_mid"),
                        F.col(valid_col).alias("_v"))
    u = m.unionByName(o)
    is_o = ~F.col("_is_msg")
    return u.agg(
        F.count_if(F.col("_is_msg")).alias("messages_scanned"),
        F.count_distinct(F.when(is_o, F.col("_mid"))).alias("messages_with_attachments"),
        F.count_if(is_o).alias("total_attachments"),
        F.coalesce(F.sum(F.when(is_o & F.col("_v"), 1).when(is_o, 0)), F.lit(0)).cast("bigint").alias("valid_invoices"),
        F.coalesce(F.sum(F.when(is_o & ~F.col("_v"), 1).when(is_o, 0)), F.lit(0)).cast("bigint").alias(
            "invalid_invoices"),
    )


def exit_status(df: DataFrame, bad: Column, name: str = "exit_code") -> DataFrame:
    """1 when any row is bad, else 0 (one row, even on empty input)."""
    return df.agg(F.coalesce(F.max(F.when(bad, 1).otherwise(0)), F.lit(0)).alias(name))


def route_by_outcome(outcomes: DataFrame, filename_col: str = "filename", lang_col: str = "lang_code",
                     valid_col: str = "is_valid", empty_col: str | None = "is_empty",
                     raw_container: str = vocab.RAW_INVOICE_CONTAINER,
                     invalid_container: str = vocab.INVALID_INVOICE_CONTAINER) -> DataFrame:
    """B2: valid -> raw container as ``<stem>_<lang><ext>``; invalid -> invalid
    container, name unchanged; empty text -> not stored (both null)."""
    empty = F.col(empty_col) if empty_col else F.lit(False)
    valid = F.col(valid_col)
    container = (F.when(empty, F.lit(None).cast("string"))
                 .when(valid, F.lit(raw_container)).otherwise(F.lit(invalid_container)))
    blob = (F.when(empty, F.lit(None).cast("string"))
            .when(valid, nm.raw_invoice_blob_name(F.col(filename_col), F.col(lang_col)))
            .otherwise(F.col(filename_col)))
    return outcomes.withColumns({"container": container, "blob_name": blob,
                                 "content_type": nm.content_type_for(F.col(filename_col), "attachment")})


def split_valid_invalid(outcomes: DataFrame, valid_col: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """The two halves of one DataFrame."""
    return outcomes.where(F.col(valid_col)), outcomes.where(~F.col(valid_col))
