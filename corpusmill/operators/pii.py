"""Detection and redaction of personal data: spans are arrays of structs (tag, value, start, end)."""

from __future__ import annotations

import ipaddress
import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.hashing import keyed_index

SPANS = "array<struct<tag:string,value:string,start:int,end:int>>"

#: Popular public DNS servers, never redacted: fixed values.
POPULAR_DNS = (
    "8.8.8.8", "8.8.4.4", "1.1.1.1", "1.0.0.1", "76.76.19.19", "76.223.122.150", "9.9.9.9",
    "149.112.112.112", "208.67.222.222", "208.67.220.220", "8.26.56.26", "8.20.247.20", "94.140.14.14", "94.140.15.15",
)

#: Shapes of dates that IP and key patterns also match.
DATES = tuple(re.compile(p) for p in (r"\d{4}[./-]\d{1,2}[./-]\d{1,2}", r"\d{1,2}[./-]\d{1,2}[./-]\d{4}", r"\d{1,2}[./-]\d{1,2}[./-]\d{2}", r"\d{4}[./-]\d{1,2}", r"\d{1,2}[./-]\d{4}"))

_DELIMITERS = r"[\x08\s@,?!;:'\"()\[\]{}<>=|\\*#&/¿¡\p{Han}]"
_HEX = "[0-9A-Fa-f]{1,4}"
_IPV6 = (
    rf"(?:(?:{_HEX}:){{7}}(?:{_HEX}|:)|(?:{_HEX}:){{6}}(?::{_HEX}|:)|(?:{_HEX}:){{5}}(?::{_HEX}){{1,2}}|(?:{_HEX}:){{4}}(?::{_HEX}){{1,3}}"
    rf"|(?:{_HEX}:){{3}}(?::{_HEX}){{1,4}}|(?:{_HEX}:){{2}}(?::{_HEX}){{1,5}}|{_HEX}:(?::{_HEX}){{1,6}}|:(?::{_HEX}){{1,7}})"
)
_PART = r"(?:25[0-5]|2[0-4]\d|1?\d{1,2})"


def _patterns() -> dict:
    import regex

    ip = regex.compile(rf"(?:^|{_DELIMITERS})(?P<v>(?:{_PART}\.){{3}}{_PART}|{_IPV6})(?:$|{_DELIMITERS}|\.(?:\s|$))", regex.M)
    email = regex.compile(
        r"(?<=^|[\x08\s@,!?;:'\"()\[\]{}<>=|\p{Han}¿¡.\\/])(?P<v>[^\s@,!?;:'\"()\[\]{}<>=|\\]*[^\s@,!?;:'\"()\[\]{}<>=|\\.]"
        r"@(?:[^\s@.,!?;:'\"()\[\]{}<>=|\\/]+\.){1,10}(?:[\p{L}\p{M}]{2,63}|xn--[0-9a-z-]+))(?=$|[\x08\s@,!?;'\"()\[\]{}<>=|\p{Han}¿¡\\/]|:(?!\d)|\.(?!\S))",
        regex.M,
    )
    key = regex.compile(r"(?<=^|[\x08\s'\":,;=()\[\]{}<>])(?P<v>(?:[A-Za-z]+[0-9]|[0-9]+[A-Za-z]|[-_+=/.]){4}[A-Za-z0-9_+=/.-]{4,})(?=$|[\x08\s'\":,;()\[\]{}<>])", regex.M)
    return {"EMAIL": email, "IP_ADDRESS": ip, "KEY": key}


#: Key formats that their issuers publish, assignments, and quoted strings that only their entropy marks; group v is the value.
SECRET_FORMATS = {
    "artifactory": r"(?:^|[\s=:\"'])(?P<v>AKC[a-zA-Z0-9]{10,}|AP[0-9A-F][a-zA-Z0-9]{8,})",
    "aws": r"\b(?P<v>(?:AKIA|ASIA|AGPA|AIDA|AROA|A3T[A-Z0-9])[0-9A-Z]{16})\b",
    "azure": r"AccountKey=(?P<v>[a-zA-Z0-9+/=]{88})",
    "cloudant": r"(?i:cloudant[^\n]{0,40}?[\"':=\s])(?P<v>[0-9a-f]{64}|[a-z]{24})\b",
    "discord": r"\b(?P<v>[MNO][a-zA-Z\d_-]{23,25}\.[a-zA-Z\d_-]{6}\.[a-zA-Z\d_-]{27})",
    "github": r"\b(?P<v>gh[pousr]_[A-Za-z0-9]{36})\b",
    "google": r"\b(?P<v>AIza[0-9A-Za-z_-]{35})\b",
    "ibm_iam": r"(?i:ibm[^\n]{0,20}?(?:api[_-]?key|iam|token)[^\n]{0,10}?[\"':=\s])(?P<v>[a-zA-Z0-9_-]{44})(?![a-zA-Z0-9_-])",
    "ibm_cos": r"(?i:secret[_-]?access[_-]?key[\"']?\s*[:=]\s*[\"']?)(?P<v>[a-f0-9]{48})(?![a-f0-9])",
    "jwt": r"\b(?P<v>eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)\b",
    "mailchimp": r"\b(?P<v>[0-9a-z]{32}-us[0-9]{1,2})\b",
    "npm": r"\b(?P<v>npm_[A-Za-z0-9]{36})\b|//[^\n]+/:_authToken=\s*(?P<w>npm_.+|[A-Fa-f0-9-]{36})",
    "private_key": r"(?P<v>-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----)",
    "sendgrid": r"\b(?P<v>SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43})\b",
    "slack": r"\b(?P<v>xox[abpors]-[0-9A-Za-z-]{10,})\b|(?P<w>https://hooks\.slack\.com/services/[A-Z0-9]+/[A-Z0-9]+/[A-Za-z0-9]+)",
    "softlayer": r"(?i:(?:softlayer|sl)[_-]?(?:api[_-]?)?(?:key|token|pass\w*)[\"']?\s*[:=]\s*[\"']?)(?P<v>[a-z0-9]{64})(?![a-z0-9])",
    "stripe": r"\b(?P<v>[rs]k_live_[0-9A-Za-z]{24})\b",
    "twilio": r"\b(?P<v>(?:AC|SK)[0-9a-f]{32})\b",
    "assigned": r"(?i:(?:token|secret|password|passwd|api_?key)\s*[=:]\s*)[\"'](?P<v>[A-Za-z0-9+/=_-]{16,})[\"']",
    "base64": r"([\"'])(?P<v>[A-Za-z0-9+/_-]{20,}={0,2})\1",
    "hex": r"([\"'])(?P<v>[0-9a-fA-F]{20,})\1",
}
#: Bits a character that a value must exceed, where its shape alone says little.
ENTROPIES = {"assigned": 3.0, "base64": 4.5, "hex": 3.0}
#: What a text needs for a pattern to match at all; texts without any of it are not sent to Python.
NEEDED = {
    "EMAIL": "@",
    "IP_ADDRESS": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]*:|::",
    "KEY": r"[\"'][A-Za-z0-9+/_-]{16}|[MNO][A-Za-z0-9_-]{23}|(?:AC|SK)[0-9a-f]{32}|AP[0-9A-F][a-zA-Z0-9]{8}|-us[0-9]",
}
#: Parts of key formats in lower case; a text without any of them, and without the shapes above, holds no key.
KEY_PARTS = (
    "akc", "akia", "asia", "agpa", "aida", "aroa", "a3t", "accountkey", "cloudant", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "aiza", "ibm", "access_key",
    "access-key", "accesskey", "eyj", "npm_", "_authtoken", "private key", "sg.", "xox", "hooks.slack", "softlayer", "sl_", "sl-", "slkey", "sltoken", "slapi",
    "slpass", "_live_", "token", "secret", "passw", "api_key", "apikey",
)


def may_hold_keys(text: Column) -> Column:
    found = F.lit(False)
    for part in KEY_PARTS:
        found = found | F.lower(text).contains(part)
    return found | text.rlike(NEEDED["KEY"])


def is_uuid(value: str) -> bool:
    return bool(re.fullmatch(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value))


def is_sequence(value: str) -> bool:
    """Whether a value is part of an alphabet in order, once or twice over."""
    runs = ("abcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789+/")
    return any(value.lower() in run * 2 for run in runs)


def is_template(value: str) -> bool:
    return (value[0], value[-1]) in {("{", "}"), ("<", ">"), ("[", "]")} or value.startswith("${")


def names_an_id(text: str, start: int) -> bool:
    """Whether the value is assigned to something that is named an id."""
    before = text[text.rfind("\n", 0, start) + 1 : start]
    return bool(re.search(r"(?:^|[^a-zA-Z])(?:id|my_id|user_?id|uid|ids)[\"']?\s*[:=]\s*[\"']?$", before, re.I))


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in map(value.count, set(value)))


class BigramModel:
    """Mean log likelihood of letter pairs; fitted on any words, compared to a configurable threshold."""

    def __init__(self, words: list[str], threshold: float = -3.6, letters: str = "abcdefghijklmnopqrstuvwxyz"):
        counts = {(a, b): 1.0 for a in letters for b in letters}
        for word in words:
            for pair in zip(word.lower(), word.lower()[1:], strict=False):
                if pair in counts:
                    counts[pair] += 1
        totals = {a: sum(counts[a, b] for b in letters) for a in letters}
        self.logs = {(a, b): math.log(n / totals[a]) for (a, b), n in counts.items()}
        self.threshold = threshold

    def score(self, value: str) -> float:
        found = [self.logs[p] for p in zip(value.lower(), value.lower()[1:], strict=False) if p in self.logs]
        return sum(found) / len(found) if found else -math.inf

    def is_gibberish(self, value: str) -> bool:
        return self.score(value) < self.threshold


def is_version(value: str, context: str) -> bool:
    """Whether a dotted quad of one-digit parts is rather a version: it is, unless dns or server is near."""
    return value.count(".") == 3 and len(value) == 7 and not re.search("dns|server", context, re.I)


def is_version_column(value: Column, context: Column) -> Column:
    """``is_version`` in the JVM."""
    quad = (F.char_length(value) == 7) & (F.size(F.split(value, r"\.", -1)) == 4)
    return quad & ~F.lower(context).rlike("dns|server")


def is_date(value: str) -> bool:
    return any(p.fullmatch(value) for p in DATES)


def valid_ip(value: str) -> bool:
    try:
        ipaddress.ip_address(value)
    except ValueError:
        return False
    return True


def is_hash(text: str, start: int, value: str) -> bool:
    """Whether a value of a digest's length follows a word for digests on its line."""
    before = text[text.rfind("\n", 0, start) + 1 : start].lower()
    return len(value) in (32, 40, 64) and any(w in before for w in ("sha", "md5", "hash", "byte"))


def has_many_hashes(text: Column, share: float = 0.02) -> Column:
    """Whether a text names "sha" or "hash" more often than for a share of its line breaks."""
    lowered = F.lower(text)
    least = F.floor(share * tx.occurrences(text, "\n"))
    return (tx.occurrences(lowered, "sha") > least) | (tx.occurrences(lowered, "hash") > least)


def follows_hash_word(text: Column, value: Column) -> Column:
    """Whether a value of a digest's length first occurs after a word for digests on its line."""
    line = F.lower(F.substring_index(F.substring(text, F.lit(1), F.instr(text, value) - 1), "\n", -1))
    found = F.lit(False)
    for word in ("sha", "md5", "hash", "byte"):
        found = found | line.contains(word)
    return F.char_length(value).isin(32, 40, 64) & found


def detect(text: str, model: BigramModel | None = None, key_detector: str = "other", strict: bool = False) -> list[tuple[str, str, int, int]]:
    """(tag, value, start, end) sorted by start. ``strict`` reproduces the context window whose start may be negative."""
    found = []
    patterns = _patterns_cached()
    for tag in ("EMAIL", "IP_ADDRESS") + (("KEY",) if key_detector == "regex" else ()):
        for m in patterns[tag].finditer(text):
            value, (start, end) = m["v"], m.span("v")
            near = text[start - 100 : end + 100] if strict else text[max(0, start - 100) : end + 100]
            if tag == "IP_ADDRESS" and (not re.search(r"\d", value) or is_date(value) or is_version(value, near) or not valid_ip(value)):
                continue
            if tag == "KEY" and (is_date(value) or value.count("/") >= 2 or not (model and model.is_gibberish(value))):
                continue
            found.append((tag, value, start, end))
    if key_detector != "regex":
        for name, pattern in _SECRETS.items():
            for m in pattern.finditer(text):
                part = "v" if m["v"] is not None else "w"
                value, (start, end) = m[part], m.span(part)
                if entropy(value) < ENTROPIES.get(name, 0.0) or is_hash(text, start, value) or is_uuid(value) or is_sequence(value) or is_template(value) or names_an_id(text, start):
                    continue
                if name in ("base64", "hex") and model and not model.is_gibberish(value):
                    continue
                if not any(s < end and start < e for _, _, s, e in found):
                    found.append(("KEY", value, start, end))
    return sorted(found, key=lambda x: (x[2], x[0]))


_CACHE: dict = {}
_SECRETS = {name: re.compile(pattern, re.M) for name, pattern in SECRET_FORMATS.items()}


def _patterns_cached() -> dict:
    if not _CACHE:
        _CACHE.update(_patterns())
    return _CACHE


def scan(docs: DataFrame, key_detector: str = "other", model: BigramModel | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets, has_secrets and number_secrets; a null text has none.

    Plain searches in the JVM tell the texts that can hold something; only these go to Python, once each.
    """

    @F.pandas_udf(SPANS)
    def spans(texts):
        return texts.map(lambda t: [{"tag": a, "value": b, "start": c, "end": d} for a, b, c, d in detect(t, model, key_detector)] if t else [])

    text = F.col(text_col)
    may = text.contains(NEEDED["EMAIL"]) | text.rlike(NEEDED["IP_ADDRESS"]) | (F.lit(True) if key_detector == "regex" else may_hold_keys(text))
    # a plan that copies the call below a filter would run it twice
    found = spans.asNondeterministic()(F.when(may, text))
    return docs.withColumn("secrets", found).withColumn("number_secrets", F.size("secrets")).withColumn("has_secrets", F.col("number_secrets") > 0)


def merge_spans(spans: Column) -> Column:
    """Spans sorted by start, those that overlap an earlier, kept one dropped: no secret's tail comes back."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    empty = F.struct(F.slice(ordered, 1, 0).alias("kept"), F.lit(0).alias("end"))
    step = lambda acc, s: F.when(s["start"] >= acc["end"], F.struct(F.concat(acc["kept"], F.array(s)).alias("kept"), s["end"].alias("end"))).otherwise(
        F.struct(acc["kept"].alias("kept"), F.greatest(acc["end"], s["end"]).alias("end"))
    )
    return F.aggregate(ordered, empty, step, lambda acc: acc["kept"])


def fold_redaction(text: Column, spans: Column, replacement) -> Column:
    """The text with each span's value replaced; an empty gap before a span becomes one space."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.concat(acc["out"], F.when(gap == "", " ").otherwise(gap), replacement(s)).alias("out"), s["end"].alias("at"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))


def redact(docs: DataFrame, pools: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text", spans_col: str = "secrets") -> DataFrame:
    """``docs`` with new_content, references and modified. A value has one replacement in a document, chosen from its pool by a
    keyed hash; private and popular addresses stay, and so does what is no address of either version; texts without a span
    to replace, and null texts, stay as they are.

    ``references`` is the new text with replacements marked as PI:TAG:value END_PI (without the space); it is the text where there
    are no spans, empty where none is replaced. ``pools`` has EMAIL, KEY, IPV4 and IPV6.
    """
    skipped = lambda s: (s["tag"] == "IP_ADDRESS") & (tx.is_private_ip(s["value"]) | s["value"].isin(*POPULAR_DNS))

    def chosen(s: Column, pool: list[str]) -> Column:
        index = keyed_index("pii", F.concat_ws(":", F.col(id_col).cast("string"), s["value"]), len(pool))
        return F.get(F.array(*map(F.lit, pool)), index)

    def replaced(s: Column) -> Column:
        by_version = F.when(tx.is_ipv4(s["value"]), chosen(s, pools["IPV4"])).when(tx.is_ipv6(s["value"]), chosen(s, pools["IPV6"])).otherwise(s["value"])
        value = F.when(s["tag"] == "EMAIL", chosen(s, pools["EMAIL"])).when(s["tag"] == "KEY", chosen(s, pools["KEY"])).otherwise(by_version)
        return F.struct(s["tag"].alias("tag"), s["start"].alias("start"), s["end"].alias("end"), value.alias("new"))

    text = F.col(text_col)
    marked = lambda s: F.concat(F.lit("PI:"), s["tag"], F.lit(":"), s["new"], F.lit("END_PI"))
    some = lambda k: F.coalesce(F.size(k), F.lit(0)) > 0

    def folded(k: Column) -> Column:
        return F.struct(
            F.when(some(k), fold_redaction(text, k, lambda s: s["new"])).otherwise(text).alias("new_content"),
            F.when(some(k), fold_redaction(text, k, marked)).when(some(F.col(spans_col)), "").otherwise(text).alias("references"),
            some(k).alias("modified"),
        )

    kept = F.transform(merge_spans(F.filter(spans_col, lambda s: ~skipped(s))), replaced)
    found = tx.let(kept, folded)
    (name,) = [c for c in (f"__r{i}" for i in range(len(docs.columns) + 1)) if c not in docs.columns][:1]
    return docs.withColumn(name, found).select("*", *[F.col(name)[c].alias(c) for c in ("new_content", "references", "modified")]).drop(name)


#: Replacements in the addresses reserved for documentation.
POOLS = {
    "EMAIL": [f"user{i}@example.com" for i in range(10)],
    "KEY": [f"key-{i}-placeholder" for i in range(10)],
    "IPV4": [f"198.51.100.{i}" for i in range(1, 6)],
    "IPV6": [f"2001:db8::{i}" for i in range(1, 6)],
}


def counters(scanned: DataFrame) -> DataFrame:
    return scanned.agg(F.count_if("has_secrets").alias("rows_with_secrets"), F.coalesce(F.sum("number_secrets"), F.lit(0)).alias("secrets"))


def gibberish_score(value: Column, model: BigramModel) -> Column:
    """The model's mean log likelihood of a value's letter pairs, in the JVM; null without such a pair."""
    import json

    logs = F.from_json(F.lit(json.dumps({a + b: x for (a, b), x in model.logs.items()})), "map<string,double>")
    lowered = F.lower(value)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(value) - 1, F.lit(1))), lambda i: F.substring(lowered, i, F.lit(2)))
    known = F.filter(F.transform(pairs, lambda p: F.try_element_at(logs, p)), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def ner_rules(entities: Column, model: BigramModel | None = None) -> Column:
    """Model entities that are redacted: no AMBIGUOUS or USERNAME, more than 3 characters, public addresses only, keys of
    more than 8 characters that ``model``, if given, calls gibberish, names of two words or more."""
    value = lambda e: e["value"]
    address = lambda e: (tx.is_ipv4(value(e)) | tx.is_ipv6(value(e))) & ~tx.is_private_ip(value(e)) & ~value(e).isin(*POPULAR_DNS)
    odd = lambda e: F.coalesce(gibberish_score(value(e), model) < model.threshold, F.lit(True)) if model else F.lit(True)
    keep = lambda e: (
        ~e["tag"].isin("AMBIGUOUS", "USERNAME", "EMAIL_EXAMPLE", "NAME_EXAMPLE")
        & (F.char_length(value(e)) > 3)
        & ((e["tag"] != "IP_ADDRESS") | address(e))
        & ((e["tag"] != "KEY") | ((F.char_length(value(e)) > 8) & odd(e)))
        & ((e["tag"] != "NAME") | (F.size(F.split(F.trim(value(e)), r"\s+")) >= 2))
    )
    return F.filter(entities, keep)


def tagged(text: Column, entities: Column) -> Column:
    """The text with entities as <TAG>."""
    return fold_redaction(text, merge_spans(entities), lambda s: F.concat(F.lit("<"), s["tag"], F.lit(">")))


def predict_entities(docs: DataFrame, predict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs ``predict(texts) -> list of span lists`` of an external model batch by batch; the model is loaded by its caller's closure."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            yield pdf[["id"]].assign(entities=predict(pdf["text"].tolist()))

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, entities {SPANS}").withColumnRenamed("id", id_col)
