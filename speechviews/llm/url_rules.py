"""URL filters: rules indexed by their rarest literal token; a URL's tokens fetch the rules that may fit, and only those are run.

Two kinds of rules, with a verdict ``allow`` or ``block``:

- ``address`` rules such as ``example.net/en/``: a host, which stands for its subdomains too, and the beginning of the path.
- ``pattern`` rules over the URL in lower case from behind its first ``://`` on: ``*`` is any run of characters, ``^`` one
  that is no letter or digit (or an end), a leading ``||`` a host or one of its labels, a leading or closing ``|`` an end.

An address rule wins over a pattern, the longer rule over the shorter, ``block`` over ``allow``, then the smaller text. What no rule
fits is allowed. A token is a run of ASCII letters and digits; a rule is filed under that of its complete tokens which the
fewest of all URLs contain, and one without a complete token is run on every URL. Tokens are counted in one aggregation over all
URLs; rules go to the tasks in blocks of about ``BLOCK_BYTES``, one pass over the URLs for each, so a list of any length is used whole.

A null URL, or one without ``://``, has an empty host and path; patterns see it whole. Repeated rows are judged alike, an empty table
gives no rows, an empty list allows everything. Columns of the same names as the results are replaced, others pass through.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from speechviews.llm.common import stored

BLOCK_BYTES = 8 << 20  # of rules and their regular expressions, sent to the tasks at once
RULE_LENGTH = 2_000  # longest rule that is accepted

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TOKEN = re.compile("[a-z0-9]+")
RULES = "kind string, rule string, verdict string"
PARSED = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("kind", "rule", "verdict", "regex")], T.StructField("tokens", T.ArrayType(T.StringType())),
])
RESULT = ("host", "path", "rule", "verdict", "pattern")

#: The rules of the query: addresses, and patterns for hosts that sell rather than tell.
ADDRESS_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BLOCKED_PATTERNS = [
    "||adult^x^", "||ads^track^", "||casino^", "||cheap^pills^", "||escort^", "||free^bets^", "||poker^", "||porn^", "||spam^farm^", "||viagra^", "||xxx^",
]


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [("address", rule, verdict) for verdict, rule in ADDRESS_RULES] + [("pattern", p, "block") for p in BLOCKED_PATTERNS]
    return spark.createDataFrame(rows, RULES)


def address(url: str | None) -> tuple[str, str]:
    """Host, its ASCII letters in lower case, and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search("[?#]", rest)
    rest = rest[: end.start()] if end else rest
    host, slash, path = rest.partition("/")
    return host.translate(A_TO_Z), slash + path


def parsed(kind: str, rule: str) -> tuple[str, list[str]]:
    """A rule's regular expression and its complete tokens: those that any URL it fits contains as whole tokens."""
    if kind == "address":
        host, slash, path = rule.partition("/")
        # its end is open: a token there may go on in the URL
        literal = (host.translate(A_TO_Z) + (slash + path).translate(A_TO_Z)) + ("*" if slash else "")
        return r"(?:[^/]*\.)?" + re.escape(host.translate(A_TO_Z) + slash + path) + ("" if slash else r"(?:/|\Z)"), _complete(f"|{literal}|")
    text = rule.translate(A_TO_Z)
    start = "" if not text.startswith("|") else r"\A(?:[^/?#]*\.)?" if text.startswith("||") else r"\A"
    end = r"\Z" if text.endswith("|") and text.strip("|") else ""
    body = text[2:] if text.startswith("||") else text[1:] if start else text
    body = body[:-1] if end else body
    inside = "".join({"*": ".*", "^": r"(?:[^a-z0-9]|\A|\Z)"}.get(c) or re.escape(c) for c in body)
    return start + inside + end, _complete(("|" if start else "*") + body + ("|" if end else "*"))


def _complete(text: str) -> list[str]:
    return sorted({m[1] for m in re.finditer(r"(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])", text)})


def index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Written rules with ``regex`` and ``token``, the rarest of their complete tokens over all ``urls`` (``url``), or null."""

    def parse(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if len(r["rule"]) > RULE_LENGTH:
                    raise ValueError(f"a rule of more than {RULE_LENGTH} characters")
                r["regex"], r["tokens"] = parsed(r["kind"], r["rule"])
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([*[(c, pa.string()) for c in PARSED.names[:4]], ("tokens", pa.list_(pa.string()))]))

    own = stored(rules.where("rule <> ''").distinct().mapInArrow(parse, PARSED), "url-rules")
    filed = own.select("kind", "rule", "verdict", F.explode("tokens").alias("token"))
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("url", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))
    seen = urls.select(F.explode(tokens).alias("token")).join(filed.select("token").distinct(), "token").groupBy("token").count()
    ordered = Window.partitionBy("kind", "rule", "verdict").orderBy(F.coalesce("count", F.lit(0)), "token")
    rarest = filed.join(seen, "token", "left").withColumn("nth", F.row_number().over(ordered)).where("nth = 1").drop("nth", "count")
    return stored(own.drop("tokens").join(rarest, ["kind", "rule", "verdict"], "left"), "url-index")


def _judge(columns: dict, urls: list, filed: list[tuple]) -> None:
    """Improves ``columns`` (the best rules so far) by one block of rules."""
    by_token, always = {}, []
    for entry in sorted(filed, key=_priority):
        kind, rule, verdict, regex, token = entry
        made = (_priority(entry), kind, rule, verdict, re.compile(regex, re.DOTALL))
        (always if token is None else by_token.setdefault(token, [])).append(made)
    for k, url in enumerate(urls):
        lower = (url or "").translate(A_TO_Z)
        host, path = columns["host"][k], columns["path"][k]
        subject = lower.partition("://")[2] if "://" in lower else lower
        candidates = list(always)
        for token in set(TOKEN.findall(lower)) & by_token.keys():
            candidates += by_token[token]
        for made, kind, rule, verdict, regex in sorted(candidates, key=lambda c: c[0]):
            best = columns["best"][k]
            if best is not None and best <= made:
                break
            if regex.match(host + path) if kind == "address" else regex.search(subject):
                columns["best"][k] = made
                break


def _priority(entry: tuple) -> tuple:
    kind, rule, verdict = entry[:3]
    return (kind != "address", -len(rule), verdict != "block", rule)


def judged(pages: DataFrame, rules: DataFrame | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``pages`` (``url``) with ``host``, ``path``, ``verdict`` and the ``rule`` or ``pattern`` that decided it, in their order, without a shuffle."""
    rules = default_rules(pages.sparkSession) if rules is None else rules
    filed = index(pages.select("url"), rules)
    rows = pages.drop(*[c for c in pages.columns if c.lower() in RESULT])
    size = filed.agg(F.sum(F.octet_length("rule") + F.octet_length("regex") + 32)).first()[0] or 0
    number = F.pmod(F.xxhash64("kind", "rule", "verdict"), F.lit(-(-size // block_bytes) or 1))
    parts = filed.withColumn("part", number).select("part").distinct().orderBy("part").collect()
    kept = rows.columns
    made = T.StructType([*rows.schema.fields, *[T.StructField(c, T.StringType()) for c in RESULT]])

    def with_block(block_rules: list[tuple]):
        def apply(batches):
            for batch in batches:
                urls = batch.column("url").to_pylist()
                old = {c: batch.column(c).to_pylist() if c in batch.schema.names else [None] * len(urls) for c in RESULT}
                both = [address(u) for u in urls]
                best = [
                    _priority(("address" if r else "pattern", r or p, v)) if r or p else None for r, p, v in zip(old["rule"], old["pattern"], old["verdict"])
                ]
                columns = {"host": [h for h, _ in both], "path": [p for _, p in both], "best": best}
                _judge(columns, urls, block_rules)
                found = columns["best"]
                results = {
                    "host": columns["host"], "path": columns["path"],
                    "rule": [b[3] if b and not b[0] else None for b in found],
                    "verdict": ["block" if b and not b[2] else "allow" for b in found],
                    "pattern": [b[3] if b and b[0] else None for b in found],
                }
                arrays = [batch.column(c) for c in kept] + [pa.array(results[c], pa.string()) for c in RESULT]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *RESULT])

        return apply

    for k, part in enumerate(parts or [None]):
        own = [] if part is None else [tuple(r) for r in filed.where(number == part.part).select("kind", "rule", "verdict", "regex", "token").collect()]
        rows = (stored(rows, "url-judged") if k else rows).mapInArrow(with_block(own), made)
    return rows


def allowed(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """The pages whose URL no rule blocks, whole."""
    return judged(pages, rules).where("verdict = 'allow'").select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULT])


def _sql_list(rows):
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)


#: The same in DuckDB, every rule on every URL.
ORACLE = f"""
WITH address_rules(verdict, rule) AS (VALUES {_sql_list(ADDRESS_RULES)}),
patterns(regex) AS (VALUES {_sql_list([(re.sub("[|]{2}", "^([^/?#]*[.])?", p.replace("^", "([^a-z0-9]|$)")),) for p in BLOCKED_PATTERNS])}),
cut AS (
  SELECT page_id, url, strpos(url, '://') AS mark, row_number() OVER () AS rid,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS rest,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_url
  FROM pages
), parts AS (
  SELECT rid, page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) AS path, CASE WHEN mark > 0 THEN substr(lower_url, mark + 3) ELSE lower_url END AS subject
  FROM cut
), fits AS (
  SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM parts, address_rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY rid
), spam AS (SELECT DISTINCT rid FROM parts, patterns WHERE regexp_matches(subject, regex))
SELECT page_id, host, path, rule, coalesce(f.verdict, CASE WHEN s.rid IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts AS p LEFT JOIN fits AS f USING (rid) LEFT JOIN spam AS s USING (rid)
"""
