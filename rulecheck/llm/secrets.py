"""Secret scans with a trigram inverted index. Native: DataFrame functions only.

``trigram_query`` derives from each rule's regular expression a Boolean query: a list of alternatives, each a set of
trigrams that every match must hold (in lower case). ``index`` gives the postings (trigram, text key) of the trigrams
that some query uses; ``candidates`` intersects the postings of each alternative and unites the alternatives; ``scan``
verifies the candidates with the regular expression itself. A rule without mandatory trigrams (hex) scans every text.
The index is a superset filter: a text key is a hash, and a collision only adds a candidate.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecheck.llm.common import free_name, let, prefix_sums, table, without


@dataclass(frozen=True)
class Rule:
    """``pattern``: the whole match is a finding if it (or, if given, its last group) has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    base: bool = False


#: The patterns and lengths of the first three are fixed by the result contract. They are matched leftmost, without overlap.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", r"[0-9a-f]{32,}", 32, 0, True),
    Rule("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

_MOST = 64  # strings that a part of a pattern may stand for before it counts as unknown


def _strings(parsed, anything: list[str | None]) -> list[list[str | None]]:
    """The words of a pattern: every way to write it as literal runs, None between runs that anything may separate."""
    ways: list[list[str | None]] = [[]]

    def then(new: list[list[str | None]]) -> None:
        nonlocal ways
        ways = [a + b for a in ways for b in new] if len(ways) * len(new) <= _MOST else [a + anything for a in ways]

    for op, arg in parsed:
        if op is C.LITERAL:
            then([[chr(arg)]])
        elif op is C.IN and all(k in (C.LITERAL, C.RANGE) for k, _ in arg):
            chars = sorted({chr(c).lower() for k, v in arg for c in ([v] if k is C.LITERAL else range(v[0], v[1] + 1))})
            then([[c] for c in chars] if len(chars) <= 6 else [anything])
        elif op is C.SUBPATTERN:
            then(_strings(arg[3], anything))
        elif op is C.BRANCH:
            then([w for branch in arg[1] for w in _strings(branch, anything)])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1:
            then([[], *_strings(arg[2], anything)])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] == arg[1] == 1:
            then(_strings(arg[2], anything))
        else:
            then([anything])
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams that any match holds, in lower case. Empty: some match may hold none, so scan fully."""
    found = set()
    for way in _strings(_parser.parse(pattern), [None]):
        runs, run = [], ""
        for c in [*way, None]:
            if c is None:
                runs.append(run.lower())
                run = ""
            else:
                run += c
        found.add(frozenset(r[i:i + 3] for r in runs for i in range(len(r) - 2)))
    if frozenset() in found:
        return []
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def text_key(row_key: str, text: str) -> Column:
    return F.xxhash64(F.col(row_key), F.col(text))


def index(docs: DataFrame, trigrams: list[str], row_key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (trigram, key): which of the trigrams a text holds, in either case. Null text: none."""
    low = F.lower(F.col(text))
    held = let(low, lambda t: F.filter(F.array(*map(F.lit, trigrams)), lambda g: F.contains(t, g)))
    return docs.select(text_key(row_key, text).alias("key"), F.explode(held).alias("trigram")).distinct()


def candidates(postings: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): the rules whose query a text meets. The postings of an alternative are intersected by counting
    its trigrams for each key, so a frequent trigram's postings are spread over the keys, never gathered."""
    asked = [(rule.kind, n, sorted(alternative)) for rule in rules for n, alternative in enumerate(trigram_query(rule.pattern))]
    hits = [F.when(F.count_if(F.col("trigram").isin(grams)) == len(grams), F.lit(kind)) for kind, _, grams in asked]
    kinds = F.filter(F.array(*hits), lambda k: k.isNotNull())
    return (postings.groupBy("key").agg(F.array_distinct(kinds).alias("kinds"))
            .filter(F.size("kinds") > 0))


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of a rule's findings in code points, end exclusive.

    The gaps between the matches (split) and the matches (extract) have the same engine and order, so running sums of
    their lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))

    def place(gaps: Column, matches: Column) -> Column:
        long = lambda x: F.char_length(x).cast("bigint")
        steps = F.zip_with(F.transform(F.slice(gaps, F.lit(1), F.size(matches)), long), F.transform(matches, long), lambda g, m: g + m)
        value = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        ends = let(prefix_sums(steps), lambda before: F.transform(matches, lambda m, i: F.get(before, i) + long(F.get(gaps, i))))
        return let(ends, lambda starts: let(value, lambda vs: F.filter(
            F.transform(matches, lambda m, i: F.when(F.char_length(F.get(vs, i)) >= rule.least, F.struct(
                F.get(starts, i).alias("start"), (F.get(starts, i) + long(m)).alias("end")))), lambda s: s.isNotNull())))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return let(found, lambda ms: F.when(F.size(ms) == 0, none).otherwise(
        let(F.split(text, rule.pattern, -1), lambda gaps: place(gaps, ms))))


def scan(docs: DataFrame, rules: list[Rule] = RULES, row_key: str = "doc_id", text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with ``secrets``: array<struct<start, rank, end, kind>>, ascending; rank is the rule's place in the list.

    Null text counts as empty; rows of any key, also null or repeated, keep their own findings; other columns stay (one named as the new one is replaced).
    """
    docs = without(docs, [out])
    asked = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    trigrams = sorted({g for query in asked.values() for alternative in query for g in alternative})
    key, kinds = free_name(docs, "_key"), free_name(docs, "_kinds")
    met = candidates(index(docs, trigrams, row_key, text), rules).select(F.col("key").alias(key), F.col("kinds").alias(kinds))
    joined = docs.withColumn(key, text_key(row_key, text)).join(met, key, "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")

    def named(rule: Rule, rank: int) -> Column:
        found = F.transform(spans(whole, rule), lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))
        return F.when(F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)), found).otherwise(empty) if asked[rule.kind] else found

    return joined.select(*docs.columns, F.sort_array(F.concat(*[named(r, i) for i, r in enumerate(rules)])).alias(out))


def redact(found: DataFrame, text: str = "text", secrets: str = "secrets", mark: str = "[redacted]") -> DataFrame:
    """scan's rows with each finding (overlapping ones as one) replaced by ``mark`` in the text; without ``secrets``.

    The text is cut at the ends of the united spans. Null texts and texts without findings stay as they are.
    """
    def union(ss: Column) -> Column:
        """Spans ascending by start: a span opens a new piece if it starts at or after the largest end so far."""
        first = F.array(F.struct(ss[0]["start"].alias("start"), ss[0]["end"].alias("end")))
        return F.aggregate(F.slice(ss, F.lit(2), F.size(ss)), first, lambda a, s: F.when(
            s["start"] >= F.element_at(a, -1)["end"], F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        ).otherwise(F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"))))))

    whole = F.col(text)
    cut = let(union(F.col(secrets)), lambda us: F.concat(
        F.array_join(F.transform(us, lambda u, i: F.concat(
            whole.substr((F.coalesce(F.get(us, i - 1)["end"], F.lit(0)) + 1).cast("int"), (u["start"] - F.coalesce(F.get(us, i - 1)["end"], F.lit(0))).cast("int")),
            F.lit(mark))), ""),
        whole.substr((F.element_at(us, -1)["end"] + 1).cast("int"), F.lit(2**31 - 1))))
    return found.withColumn(text, F.when(F.size(secrets) > 0, cut).otherwise(whole)).drop(secrets)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_trigram_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and spans of the base rules, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in RULES if r.base]))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))
