"""Ticket store: snapshot, corpus text, lookups, and the router that picks one by the question's wording."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .shaping import latest, only_existing, require

SHOWN = ["number", "state", "assigned_to", "category", "sys_updated_on"]


def snapshot(history: DataFrame, order: tuple[str, ...] = ("sys_updated_on", "as_of_date", "event_id")) -> DataFrame:
    """The newest version of each ticket over the whole history, so taking in a file again changes nothing."""
    return latest(require(history, ["number"]), ["number"], [c for c in order if c in history.columns])


def corpus(tickets: DataFrame, fields: list[str]) -> DataFrame:
    """tickets with `text` of labelled fields; those with no field filled are left out."""
    out = tickets.withColumn("text", S.labelled_text({f: f for f in fields if f in tickets.columns}))
    return out.where("text <> ''")


def by_number(tickets: DataFrame, number: str) -> DataFrame:
    return only_existing(tickets.where(F.col("number") == number), SHOWN).limit(1)


def stale(tickets: DataFrame, now: str, days: int = 7, k: int = 50) -> DataFrame:
    """The k least recently updated open tickets not touched for `days`. No state counts as open; no time is left out."""
    old = F.col("sys_updated_on") < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    rows = tickets.where((F.coalesce("state", F.lit("")) != "Closed") & old)
    return only_existing(rows, SHOWN).orderBy(F.asc_nulls_last("sys_updated_on"), "number").limit(k)


def by_assignee(tickets: DataFrame, name: str, k: int = 100) -> DataFrame:
    rows = tickets.where(F.lower("assigned_to") == name.lower())
    return only_existing(rows, SHOWN).orderBy(F.desc_nulls_last("sys_updated_on"), "number").limit(k)


def route(question: str) -> tuple[str, dict]:
    """(lookup, its arguments): by ticket number; then by staleness, if the question is of tickets that aren't closed, with the
    days of "last 5 days"; then by assignee, a name of three letters or more; else by similarity."""
    if m := re.search(S.TICKET, question.upper()):
        return "number", {"number": m[1]}
    if re.search(S.STALE, question) and re.search(S.STILL_OPEN, question):
        d = re.search(S.DAYS, question.lower())
        return "stale", {"days": int(d[1]) if d else 7}
    if (m := re.search(S.ASSIGNEE, question)) and len(name := m[1].strip().strip("\"'")) >= 3:
        return "assignee", {"name": name}
    return "similar", {"text": question}


def answer(tickets: DataFrame, question: str, now: str, similar: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The rows that answer a question. similar: a search by text, for questions that name nothing."""
    kind, how = route(question)
    if kind == "number":
        return by_number(tickets, **how)
    if kind == "stale":
        return stale(tickets, now, **how)
    if kind == "assignee":
        return by_assignee(tickets, **how)
    if similar is None:
        raise ValueError("a search by similarity needs an embedder")
    return similar(how["text"])
