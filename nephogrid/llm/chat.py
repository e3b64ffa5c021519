"""Chat formatting by event-sourced reconstruction.

A log row is one event of a message of a conversation. Logs are dealt by conversation and stretch of messages, sorted by message, entry and
sequence, and folded: ``message`` and ``start`` open a message, ``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` empties it for the
deltas that follow. Stretches are rendered where they are folded; a conversation then only gathers its finished stretches.

The template is ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. In texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so
no control string can appear in them and undoing it is unambiguous; a line break in a role becomes ``\\n``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephogrid.llm._common import small_batches

START, END = "<|im_start|>", "<|im_end|>\n"
#: Messages that are folded and rendered together.
STRETCH = 256
LOSS_ROLE = "assistant"
KINDS = ("message", "start", "delta", "edit", "regenerate")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted text and the spans (code points) of the texts that count for the loss."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in messages:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LOSS_ROLE:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), starts, ends


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of the turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("not a formatted conversation")
        line = formatted.index("\n", at)
        stop = formatted.index(END, line)
        out.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : stop])))
        at = stop + len(END)
    return out


def format_logs(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, starts, ends) for every conversation of (conv_id, message, seq, kind, role, text) and, if there, entry (a number).

    Messages come in order of ``message``; those of one number are told apart by ``entry`` and ordered by role and final text. Events of a
    message come in order of ``seq``; rows that tie are ordered by role and text, and each ``message`` or ``start`` row opens a message of its
    own, so repeated rows give repeated messages. Deltas, edits and regenerations before any opening open a message themselves. Null roles and
    texts are empty; null messages, entries and sequences come first; rows without conv_id form one conversation; unknown kinds raise. Empty
    logs give no conversations; other columns are ignored. A conversation is one row of the result, so its text has to fit a task.
    """
    small_batches(events.sparkSession)
    entry = F.col("entry").cast("long") if "entry" in events.columns else F.lit(None).cast("long")
    e = events.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("message").cast("long").alias("message"), entry.alias("entry"), F.col("seq").cast("long").alias("seq"), F.coalesce(F.col("kind"), F.lit("message")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    e = e.withColumn("stretch", F.floor(F.col("message") / STRETCH))
    keys = ["conv_id", "stretch"]
    # numbers go through the fold as text, which keeps all 64 bits beside nulls
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    e = e.withColumn("key", F.concat_ws("/", shown("conv_id"), shown("stretch")))
    e = e.repartition(*keys).sortWithinPartitions(*keys, "message", "entry", "seq", "role", "text").select("key", shown("message").alias("message"), shown("entry").alias("entry"), "kind", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, message, entry = None, None, None
        done: list[tuple[str, str]] = []
        open_: list[tuple[str, list[str]]] = []  # of the message number at hand

        def close_number() -> None:
            done.extend(sorted(((r, "".join(t)) for r, t in open_), key=lambda x: (x[0].encode("utf-8", "surrogatepass"), x[1].encode("utf-8", "surrogatepass"))))
            open_.clear()

        def close_stretch() -> pd.DataFrame:
            close_number()
            formatted, starts, ends = render(done)
            done.clear()
            return pd.DataFrame({"key": [key], "formatted": [formatted], "starts": [np.array(starts, np.int64)], "ends": [np.array(ends, np.int64)]})

        for b in batches:
            for k, m, e, kind, role, text in zip(b["key"], b["message"], b["entry"], b["kind"], b["role"], b["text"], strict=True):
                if k != key:
                    if key is not None:
                        yield close_stretch()
                    key, message, entry = k, None, None
                if m != message:
                    close_number()
                if kind not in KINDS:
                    raise ValueError(f"unknown kind of event: {kind}")
                if kind in ("message", "start") or (m, e) != (message, entry):
                    open_.append((role, [text]))
                    message, entry = m, e
                elif kind == "delta":
                    open_[-1][1].append(text)
                else:
                    open_[-1][1][:] = [text] if kind == "edit" else []
        if key is not None:
            yield close_stretch()

    s = e.mapInPandas(run, "key string, formatted string, starts array<long>, ends array<long>")
    conv, stretch = F.split_part(F.col("key"), F.lit("/"), F.lit(1)), F.split_part(F.col("key"), F.lit("/"), F.lit(2))
    s = s.select(F.when(conv != "-", conv.cast("long")).alias("conv_id"), F.struct(F.when(stretch != "-", stretch.cast("long")).alias("stretch"), F.col("formatted"), "starts", "ends").alias("part"))
    whole = s.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    sizes = F.transform("parts", lambda p: F.length(p["formatted"]).cast("long"))
    offsets = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    whole = whole.withColumn("offsets", offsets)

    def moved(name: str):
        return F.flatten(F.transform("parts", lambda p, i: F.transform(p[name], lambda x: x + F.get(F.col("offsets"), i))))

    return whole.select("conv_id", F.array_join(F.transform("parts", lambda p: p["formatted"]), "").alias("formatted"), moved("starts").alias("starts"), moved("ends").alias("ends"))


def digest(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read back from formatted conversations."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, t, a, z in zip(b["key"], b["formatted"], b["starts"], b["ends"], strict=True):
                turns = read_back(t)
                sha = hashlib.sha256("".join(f"{role}\n{x}\n" for role, x in turns).encode("utf-8")).hexdigest()
                loss = "".join(unescape(t[i:j]) for i, j in zip(a, z, strict=True))
                rows.append((key, len(turns), sha, len(loss), hashlib.sha256(loss.encode("utf-8")).hexdigest(), len(t)))
            yield pd.DataFrame(rows, columns=["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    small_batches(formatted.sparkSession)
    # the id goes as text, which keeps all 64 bits beside nulls
    keyed = formatted.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")).alias("key"), "formatted", "starts", "ends")
    got = keyed.mapInPandas(run, "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return got.select(F.when(F.col("key") != "-", F.col("key").cast("long")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
