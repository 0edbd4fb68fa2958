"""URL filters: rules are found through their rarest literal token, then tried as regular expressions."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.stage import ship

TOKEN = "[0-9A-Za-z]+"
#: The rules travel with every task, so their number is bounded.
MAX_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains, from a path prefix on; an empty host fits every host."""

    host: str
    path: str
    verdict: str

    def __post_init__(self) -> None:
        if self.path and not self.path.startswith("/"):
            raise ValueError(f"a rule's path starts with /: {self}")

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        host = rf"(?:[^/]*\.)?{re.escape(self.host)}" if self.host else "[^/]*"
        return host + (re.escape(self.path) if self.path else r"(?=/|\Z)")

    def tokens(self) -> set[str]:
        """Tokens that every URL it fits holds as whole tokens; a last one may go on in the URL."""
        return {
            m.group()
            for m in re.finditer(TOKEN, self.text)
            if m.end() < len(self.text) or not self.path
        }


def url_host(url: str) -> Column:
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.when(F.col(url).contains("://"), F.translate(host, _UPPER, _LOWER)).otherwise("")


def url_path(url: str) -> Column:
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    path = F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1)
    return F.when(F.col(url).contains("://"), path).otherwise("")


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many URLs each token of a rule stands; never more entries than the rules have tokens."""
    wanted = sorted({t for rule in rules for t in rule.tokens()})
    if not wanted:
        return {}
    found = urls.select(F.explode(F.array_distinct(F.expr(f"regexp_extract_all(concat(host, path), '{TOKEN}', 0)"))).alias("token"))
    known = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    counts = found.groupBy("token").agg(F.count("*").alias("n"))  # before the join, as one token may stand in every URL
    return {r.token: r.n for r in counts.join(known, "token").collect()}


def index_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules under their rarest token; those without a token stand under the empty one."""
    index = defaultdict(list)
    for rule in rules:
        index[min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")].append(rule)
    return dict(index)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: id, host, path, rule and verdict.

    The longest rule that fits decides; of equally long ones a block, then the smallest text. Without
    a rule the verdict is ``default``. A null URL or one without ``://`` has an empty host and path.
    Repeated pages are judged each; other columns are not carried, so their names cannot clash.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    ship(pages.sparkSession)
    urls = pages.select(F.col(id_col).alias("id"), url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    index = index_rules(rules, token_counts(urls, rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = re.compile(TOKEN)
        tries = {
            t: [((-len(r.text), r.verdict != "block", r.text), r, re.compile(r.pattern)) for r in under]
            for t, under in index.items()
        }
        for batch in batches:
            fits: list[Rule | None] = []
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True):
                subject = host + path
                found = [
                    (rank, rule)
                    for t in {"", *token.findall(subject)}
                    for rank, rule, pattern in tries.get(t, ())
                    if pattern.match(subject)
                ]
                fits.append(min(found, key=lambda x: x[0])[1] if found else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r and r.text for r in fits], pa.string()),
                    pa.array([r.verdict if r else default for r in fits], pa.string()),
                ],
                [*batch.schema.names, "rule", "verdict"],
            )

    kind = urls.schema["id"].dataType.simpleString()
    judged = urls.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id_col)
