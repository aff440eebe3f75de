"""What a statement reads and asks for, told from its parsed plan before anything runs.

Spark's own parser makes the plan, so comments, aliases, nested queries and any spelling are
seen as Spark will see them. Stored SQL texts, of which there may be very many, are checked as text
by ``audits.sql_lint``.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass

from py4j.java_gateway import is_instance_of
from pyspark.sql import SparkSession

from eventloom import vocab

TABLE = "EVENTS"
PLAIN_COLUMNS = ("EVENT", "JOB_ID", "STATE", "STATUS")
#: Rules whose breach keeps a statement from running, and those that are only told.
REFUSED = ("no_query", "other_table", "path_not_rooted")
TOLD = ("path_not_literal", "text_field_equals", "plain_column_like", "unknown_key")
_NO_QUERY = ("catalyst.plans.logical.Command", "catalyst.plans.logical.ParsedStatement")
_EQUALITIES = ("EqualTo", "EqualNullSafe", "In")
_LIKES = ("Like", "ILike", "RLike")


@dataclass(frozen=True)
class Finding:
    rule: str
    detail: str


def _each(sequence) -> Iterator:
    """Entries of a Scala sequence."""
    return (sequence.apply(i) for i in range(sequence.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _expressions(node) -> Iterator:
    """A plan node's expressions and all below them, without the queries inside."""
    waiting = list(_each(node.expressions()))
    while waiting:
        expression = waiting.pop()
        yield expression
        waiting += _each(expression.children())


def _below(expression) -> Iterator:
    yield expression
    for child in _each(expression.children()):
        yield from _below(child)


def _called(expression) -> str | None:
    """The name of a called function."""
    if _kind(expression) != "UnresolvedFunction":
        return None
    return list(_each(expression.nameParts()))[-1].lower()


def _path(call, spark: SparkSession) -> str | None:
    """The path of a ``json_extract`` call, constant expressions worked out; None if it depends on a row."""
    arguments = list(_each(call.arguments()))
    if len(arguments) != 2:
        return None
    if any(_kind(e) in ("UnresolvedAttribute", "UnresolvedStar") or "Subquery" in _kind(e) for e in _below(arguments[1])):
        return None
    return spark.sql(f"SELECT CAST({arguments[1].sql()} AS STRING)").first()[0]


def _key(path: str | None) -> str | None:
    found = re.match(r"\$\.([A-Za-z_0-9]+)", path or "")
    return found.group(1) if found else None


def _calls(expression) -> list:
    return [e for e in _below(expression) if _called(e) == "json_extract"]


class _Walk:
    def __init__(self, spark: SparkSession, known_keys: Collection[str] | None):
        self.spark, self.gateway, self.known, self.found = spark, spark.sparkContext._gateway, known_keys, []

    def tell(self, rule: str, detail: str) -> None:
        finding = Finding(rule, detail)
        if finding not in self.found:
            self.found.append(finding)

    def plan(self, node, named: frozenset[str]) -> None:
        """Check a plan node; ``named`` are the names that queries in WITH have here."""
        kind = _kind(node)
        if any(is_instance_of(self.gateway, node, f"org.apache.spark.sql.{c}") for c in _NO_QUERY):
            self.tell("no_query", kind)
            return
        if kind == "UnresolvedWith":
            # Each query sees those before it; what follows sees all.
            for entry in _each(node.cteRelations()):
                name = entry._1().lower()
                self.plan(entry._2(), named | {name} if node.allowRecursion() else named)
                named = named | {name}
            for child in _each(node.children()):
                self.plan(child, named)
            return
        if kind == "UnresolvedRelation":
            parts = list(_each(node.multipartIdentifier()))
            if len(parts) != 1 or parts[0].lower() not in named | {TABLE.lower()}:
                self.tell("other_table", ".".join(parts))
        elif node.children().size() == 0 and kind not in ("OneRowRelation", "OneRowRelation$"):
            self.tell("other_table", kind)
        for expression in _expressions(node):
            self.expression(expression)
        for inner in (*_each(node.children()), *_each(node.innerChildren())):
            self.plan(inner, named)

    def expression(self, expression) -> None:
        kind = _kind(expression)
        if _called(expression) == "json_extract":
            path = _path(expression, self.spark)
            if path is None:
                self.tell("path_not_literal", expression.toString())
            elif not path.startswith("$"):
                self.tell("path_not_rooted", f"a JSON path starts with $, not {path}")
            elif self.known is not None and _key(path) not in self.known:
                self.tell("unknown_key", path)
        elif kind in _EQUALITIES:
            sides = list(_each(expression.children()))
            for call in (c for side in (sides if kind != "In" else sides[:1]) for c in _calls(side)):
                path = _path(call, self.spark)
                if _key(path) in vocab.TEXT_KEYS:
                    self.tell("text_field_equals", path)
        elif kind in _LIKES:
            left = expression.children().apply(0)
            if _kind(left) == "UnresolvedAttribute":
                name = list(_each(left.nameParts()))[-1].upper()
                if name in PLAIN_COLUMNS:
                    self.tell("plain_column_like", name)


def findings(spark: SparkSession, sql: str, known_keys: Collection[str] | None = None) -> list[Finding]:
    """The rules that a statement breaks, with what breaks them.

    ``known_keys`` are the metadata keys of the sample that the statement was written for.
    """
    walk = _Walk(spark, known_keys)
    walk.plan(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset())
    return walk.found


def refuse(spark: SparkSession, sql: str, known_keys: Collection[str] | None = None, rules: Collection[str] = REFUSED) -> None:
    """Raise ``ValueError`` if a statement breaks one of the rules."""
    broken = [f for f in findings(spark, sql, known_keys) if f.rule in rules]
    if broken:
        raise ValueError("the statement is refused: " + "; ".join(f"{f.rule} ({f.detail})" for f in broken))
