"""URL filters as a whole against a plain program: host, path, rule, segmentation, naive Bayes, verdict."""

import collections
import itertools
import math
import random
import re
import time

import pytest

from judgex.llm import urls

SCHEMA = "page_id long, url string, html string"


def _plain(rows, seeds):
    """Rows by page: (host, path, rule, verdict, words)."""
    public = urls.public_words()
    counts = collections.Counter(w for _, _, h in rows for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", (h or "").lower())))
    total = sum(counts.values())
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = []
    for k, url, _ in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        raw = re.match(r"[^/?#]*", rest)[0]
        parts.append((k, raw.translate(low), re.match(r"[^?#]*", rest[len(raw) :])[0]))

    def split(name):
        have, every = urls.known_words(name, {w: c for w, c in counts.items() if w in name}, total, public, seeds)
        best = {0: (0.0, [])}
        for end in range(1, len(name) + 1):
            tries = []
            for start in range(end):
                w = name[start:end]
                chance = math.log(have[w] / every) if have.get(w) else math.log(10 / every) - len(w) * math.log(10)
                tries.append((best[start][0] + chance, -start, [*best[start][1], w]))
            score, _, words = max(tries, key=lambda t: (round(t[0], 9), t[1]))
            best[end] = (score, words)
        words = best[len(name)][1]
        return words, all(w in have for w in words) and bool(set(seeds) & set(words))

    hosts = {}
    for _, host, _ in parts:
        if host not in hosts:
            found = [split(n) for n in re.findall("[a-z]+", ".".join(host.split(".")[:-1]))]
            hosts[host] = ([w for x in found for w in x[0]], any(x[1] for x in found))
    tokens = lambda path: re.findall("[a-z]+|#", re.sub("[0-9]+", "#", path.translate(low)))
    seen, prior = [collections.Counter(), collections.Counter()], [1, 1]
    for _, host, path in parts:
        words, block = hosts[host]
        seen[block].update([*words, *tokens(path)])
        prior[block] += 1
    both = seen[0] + seen[1]
    n, v = [sum(s.values()) for s in seen], len(both)

    def weight(t):
        extra = v * both[t] / sum(both.values())
        return math.log((seen[1][t] + extra) / (n[1] + v)) - math.log((seen[0][t] + extra) / (n[0] + v))

    out = []
    for k, host, path in parts:
        fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        odds = math.log(prior[1] / prior[0]) + sum(weight(t) for t in [*hosts[host][0], *tokens(path)])
        out.append((k, host, path, rule.text if rule else None, rule.verdict if rule else "block" if odds > 0 else "allow", tuple(hosts[host][0])))
    return out


def test_judge_brute_force(spark):
    rng = random.Random(7)
    names = ["cheappills", "bestcasino", "gardening", "physics", "slots", "torrentialrain", "adsense", "replicationstudies", "news", "theblog", "abcab", "qqqq", "freebets", "x1y2", "spam-farm"]
    tops = ["com", "net", "org", "example.com", "www.example.com", "co.uk"]
    paths = ["/en/1", "/es/a-b", "/fr/", "/win/now", "/News/2024/05", "", "/en/?q=/es/", "/a#b"]
    rows = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'm.', 'WWW.'])}{rng.choice(names)}.{rng.choice(tops)}{rng.choice(paths)}", "<p>abc ab the blog physics") for i in range(300)]
    rows += [(300, None, None), (301, "no scheme", ""), (302, "://", "x"), (303, "a://b://c/d", "<p>free bets"), (304, "http://example.com", None), (305, "http://EXAMPLE.COM/en/x?y", None)]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, tuple(r.words)) for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(_plain(rows, urls.SEEDS), key=repr)
    by_host = {r[1]: r[4] for r in got if r[3] is None}
    assert by_host["bestcasino.org"] == "block" and {by_host.get(f"{n}.org", "allow") for n in ("torrentialrain", "adsense", "replicationstudies", "physics")} == {"allow"}


def test_viterbi_finds_the_likeliest():
    rng = random.Random(5)
    for _ in range(150):
        name = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        counts = {"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(1, 5000) for _ in range(8)}
        score = lambda ws: sum(math.log(counts[w] / 9000) if w in counts else math.log(10 / 9000) - len(w) * math.log(10) for w in ws)  # noqa: B023, E731
        every = [[name[a:b] for a, b in itertools.pairwise((0, *cut, len(name)))] for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)]
        assert abs(score(urls.viterbi(name, counts, 9000)) - max(map(score, every))) < 1e-9


@pytest.mark.parametrize("letters", [5000])
def test_very_long_hosts(spark, letters):
    rng = random.Random(letters)
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=letters))
    rows = [(1, f"http://{long}.org/x", f"<p>{long} and words of many lengths {'x' * 300} {'y' * 40}"), (2, "http://cheap-pills.org/", "<p>cheap pills")]
    began = time.monotonic()
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].words == [long] and got[2].words == ["cheap", "pills"] and time.monotonic() - began < 120
