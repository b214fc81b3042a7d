"""URL filters: rules first, then naive Bayes over segmented host names and path tokens.

Names in hosts run words together. A name is split by the most likely sequence of words (Viterbi) under unigram chances, half from
the words of all pages, half from the ranks of a public vocabulary's words. Corpus counts are looked up by join, a name's substrings of the lengths that
words have against the counts, so no dictionary of the corpus is cut off or broadcast. A multinomial naive Bayes model then scores the host's words and the
path's tokens. Its classes come by distant supervision: a url is an example of class block where a name in its host splits into known words alone and one of them is in
``SEEDS``, of class allow elsewhere; pseudo-counts follow the tokens' use in both classes together. Tokens are counted over all urls, in ``BUCKETS`` hash buckets, which bounds the model.

Defined results: null urls and those without :// have empty host and path, fit no rule, and get the verdict of an
empty token list (the more frequent class, allow on ties and for an empty table); repeated rows are judged one by one;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm.arrow import over, table
from judgex.session import cut


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
#: Words of host names that mark gambling, adult, pharmacy, fraud and advertising sites.
SEEDS = tuple(
    "ads adserver adult bet bets betting casino cialis escort gambling jackpot lottery malware nude payday phishing pills poker porn porno replica roulette sex slots spam torrent viagra warez xxx".split()
)
#: Fixed value: the public vocabulary, whose words are known in the order of their ids.
VOCABULARY, PUBLIC_WORDS = "byte_bpe_50k.json", 1_000_000
BUCKETS = 1 << 16
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Rows (page_id, host, path)."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract("rest", r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"\A[^?#]*", 0)
    out = pages.select("page_id", rest.alias("rest")).withColumn("raw", host).withColumn("path", path)
    return out.select("page_id", F.translate("raw", _UP, _LOW).alias("host"), "path")


def rule_of(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits host and path; nulls where none fits."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = lambda r: ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
    pick = lambda what: F.coalesce(*(F.when(fits(r), F.lit(what(r))) for r in longest)) if longest else F.lit(None).cast("string")
    return pick(lambda r: r.text), pick(lambda r: r.verdict)


def names_of(host: Column) -> Column:
    """The runs of letters in a host but its last label."""
    labels = F.split(host, r"\.")
    inner = F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))
    return F.filter(F.split(F.array_join(inner, "."), "[^a-z]+"), lambda x: x != "")


def tokens_of(path: Column) -> Column:
    """The runs of letters in a path, and # for each run of digits."""
    return F.regexp_extract_all(F.regexp_replace(F.translate(path, _UP, _LOW), "[0-9]+", "#"), F.lit("[a-z]+|#"), F.lit(0))


def public_words(path: str | None = None) -> dict[str, float]:
    """Chances of a public vocabulary's words, by Zipf's rule; of several spellings the first counts."""
    import json

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    ranks: dict[str, int] = {}
    for token, i in sorted(ids.items(), key=lambda x: x[1]):
        if re.fullmatch("\u0120[A-Za-z]{2,}", token):  # words begin with the sign for a blank
            ranks.setdefault(token[1:].lower(), i)
    whole = sum(1 / (10 + r) for r in ranks.values())
    return {w: 1 / (10 + r) / whole for w, r in ranks.items()}


def viterbi(name: str, counts: dict[str, float], total: float) -> list[str]:
    """The likeliest words that make up a name; unknown words of n letters have chance 10 / (total 10**n).

    A piece is tried at the lengths that known words have, and as unknown from the best place, so time follows the name's length.
    """
    ten, unknown = math.log(10), math.log(10 / total)
    chance = {w: math.log(c / total) for w, c in counts.items() if c}
    lengths = sorted({len(w) for w in chance}, reverse=True)
    best, open_at = [(0.0, 0)], (0.0, 0)
    for end in range(1, len(name) + 1):
        top = (open_at[0] + unknown - end * ten, open_at[1])
        for n in lengths:
            if n <= end and (c := chance.get(name[end - n : end])) is not None:
                t = (best[end - n][0] + c, end - n)
                if t[0] > top[0] or t[0] == top[0] and t[1] < top[1]:
                    top = t
        best.append(top)
        if top[0] + end * ten > open_at[0]:
            open_at = (top[0] + end * ten, end)
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def known_words(name: str, corpus: dict[str, int], total: int, public: dict[str, float], seeds: Sequence[str] = ()) -> tuple[dict[str, float], float]:
    """(weights of the known words in a name, weight of all words): those of the corpus, and as much again from the public ones.

    Seeds that neither has weigh as little as the rarest public word.
    """
    share = max(total, PUBLIC_WORDS)
    out: dict[str, float] = dict(corpus)
    for n in range(2, min(len(name), max(map(len, public), default=0)) + 1):
        for i in range(len(name) - n + 1):
            if p := public.get(name[i : i + n]):
                out[name[i : i + n]] = corpus.get(name[i : i + n], 0) + share * p
    rare = share * min(public.values(), default=1e-6)
    return {w: rare for w in seeds if w in name} | out, total + share


def _segmented(names: DataFrame, pages: DataFrame, seeds: Sequence[str]) -> DataFrame:
    """Rows (name, words, seeded) for distinct names; counts are those of words in the text of all pages."""
    text = F.regexp_replace(F.lower(F.coalesce("html", F.lit(""))), r"<[^>]*>", " ")
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]+"), F.lit(0))).alias("word"))
    counts = cut(words.groupBy("word").count(), "url-words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    lengths = sorted(r[0] for r in counts.select(F.length("word").alias("n")).filter(F.col("n") <= longest).distinct().collect())  # no more than letters in a name
    each = names.select("name", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("n")).filter(F.col("n") <= F.length("name"))
    subs = F.transform(F.sequence(F.lit(1), F.length("name") - F.col("n") + 1), lambda i: F.substring(F.col("name"), i, F.col("n")))
    found = each.select("name", F.explode(F.array_distinct(subs)).alias("word")).join(counts, "word")
    known = names.join(found.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("word", "count"))).alias("counts")), "name", "left")
    public = names.sparkSession.sparkContext.broadcast(public_words())  # of a vocabulary file

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, seeded = [], []
        for name, c in zip(b.column("name").to_pylist(), b.column("counts").to_pylist()):
            have, every = known_words(name, dict(c or ()), total, public.value, seeds)
            out.append(viterbi(name, have, every))
            seeded.append(all(w in have for w in out[-1]) and not set(seeds).isdisjoint(out[-1]))
        yield table(name=b.column("name"), words=pa.array(out, pa.list_(pa.string())), seeded=seeded)

    return over(known, f, "name string, words array<string>, seeded boolean")


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def token_weights(seen: np.ndarray) -> np.ndarray:
    """Log odds of class 1 of every token, from counts by class and token; tokens that don't occur say nothing.

    Classes are smoothed by pseudo-counts dealt as both classes together use the tokens, so a rare
    token leans to the class it was seen in, however unequal the classes are.
    """
    both = seen.sum(0)
    used = both > 0
    extra = used.sum() * both / max(1.0, both.sum())
    chance = (seen + extra) / np.maximum(1.0, (seen + extra).sum(1, keepdims=True))
    return np.where(used, np.log(np.where(used, chance[1], 1.0) / np.where(used, chance[0], 1.0)), 0.0)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, words, log_odds); odds are those of class block."""
    urls = cut(with_parts(pages), "url-parts")
    hosts = cut(urls.groupBy("host").agg(F.count(F.lit(1)).alias("urls")).withColumn("names", names_of(F.col("host"))), "url-hosts")
    names = cut(hosts.select(F.explode("names").alias("name")).distinct(), "url-names")
    split = cut(_segmented(names, pages, seeds), "url-split")
    placed = hosts.select("host", F.posexplode("names").alias("i", "name")).join(split, "name")
    words = placed.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "words"))), lambda x: x["words"])).alias("words"), F.max("seeded").alias("seeded"))
    none = F.array().cast("array<string>")
    hosts = hosts.join(words, "host", "left").select("host", "urls", F.coalesce("words", none).alias("words"), F.coalesce("seeded", F.lit(False)).alias("block"))
    hosts = cut(hosts, "url-host-words")

    host_tokens = hosts.select("block", "urls", F.explode("words").alias("t")).groupBy("block", _bucket(F.col("t")).alias("k")).agg(F.sum("urls").alias("n"))
    paths = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("urls")).join(hosts.select("host", "block"), "host")
    path_tokens = paths.select("block", "urls", F.explode(tokens_of(F.col("path"))).alias("t")).groupBy("block", _bucket(F.col("t")).alias("k")).agg(F.sum("urls").alias("n"))
    seen = np.zeros((2, BUCKETS))
    for block, k, n in host_tokens.unionAll(path_tokens).groupBy("block", "k").agg(F.sum("n")).collect():  # at most 2 * BUCKETS rows
        seen[int(block), k] += n
    prior = np.array([1.0, 1.0])
    for block, n in hosts.groupBy("block").agg(F.sum("urls")).collect():
        prior[int(block)] += n
    weight = token_weights(seen)
    base = float(np.log(prior[1] / prior[0]))
    shared = pages.sparkSession.sparkContext.broadcast(weight)

    def odds(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        col = b.column("k")
        offs = col.offsets.to_numpy() - col.offsets[0].as_py()
        sums = np.concatenate(([0.0], np.cumsum(shared.value[col.flatten().to_numpy(zero_copy_only=False)])))
        yield table(**{c: b.column(c) for c in b.schema.names if c != "k"}, odds=sums[offs[1:]] - sums[offs[:-1]])

    scored = over(hosts.select("host", "words", F.transform("words", _bucket).alias("k")), odds, "host string, words array<string>, odds double")
    rows = over(urls.select("page_id", "host", "path", F.transform(tokens_of(F.col("path")), _bucket).alias("k")), odds, _types(urls, "page_id") + ", host string, path string, odds double")
    out = rows.join(scored.select("host", "words", F.col("odds").alias("host_odds")), "host")
    log_odds = F.lit(base) + F.col("odds") + F.col("host_odds")
    rule, verdict = rule_of(rules)
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(log_odds > 0, F.lit("block")).otherwise("allow")).alias("verdict"), "words", log_odds.alias("log_odds"))


def _types(df: DataFrame, *cols: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{c} {kinds[c]}" for c in cols)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
