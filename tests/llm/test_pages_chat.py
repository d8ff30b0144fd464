"""URL language ratio and chat windows."""

import hashlib
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from vesselmart.llm import chatwindows, urlratio

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
PAGE = "page_id long, url string, host string"


def _parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path


def _rule(host, path):
    fit = []
    for rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fit.append(rule)
    return max(fit, key=len) if fit else None


URLS = [
    None, "", "no scheme", "http://", "http://X.Example.NET/en/1?q#f", "https://a.net", "https://a.net/", "ftp://NET/x",
    "http://example.com/de/", "http://example.com/de", "http://notexample.com/de/a", "http://\u00c4.org/fr/x", "a://b://c/d",
    "http://x.org/fr/\nline", "http://h?q=://z/", "http://h#f", "http://user@net:80/", "http://" + "z" * 20_000 + ".org/en",
]


def test_rules_decide_first(spark):
    rows = [(k, u, "clash") for k, u in enumerate(URLS + URLS)]
    out = urlratio.judge(spark.createDataFrame(rows, PAGE), RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = _parts(rows[r["page_id"]][1])
        assert (r["host"], r["path"], r["rule"]) == (host, path, _rule(host, path))
        if r["rule"]:
            assert r["verdict"] == RULES[r["rule"]]
        assert r["verdict"] in ("allow", "block")


def test_models_tell_the_kinds_apart(spark):
    good = [f"https://docs{k}.library.example.net/en/guide-{k}" for k in range(150)]
    bad = [f"http://xx{k}casino9win.net/{k}zz77" for k in range(150)]
    new = ["https://docs900.library.test/en/guide-7", "http://xx900casino9win.test/8zz77"]
    rows = [(k, u, None) for k, u in enumerate(good + bad + new)]
    out = {r["page_id"]: r for r in urlratio.judge(spark.createDataFrame(rows, PAGE), RULES).collect()}
    assert out[300]["verdict"] == "allow" and out[301]["verdict"] == "block"
    assert out[300]["ratio"] > 0 > out[301]["ratio"]


def test_nothing_to_learn_from(spark):
    one = spark.createDataFrame([(1, "http://a.test/x", None)], PAGE)
    assert urlratio.judge(one, RULES).first()["verdict"] == "allow"
    assert urlratio.judge(one.limit(0), RULES).count() == 0


def _string(host, path):
    """Without the top label, a label "example" before it and one leading directory."""
    labels = host.split(".")[:-1]
    if labels and labels[-1] == "example":
        labels.pop()
    first, slash, rest = path[1:].partition("/")
    return ".".join(labels) + (slash + rest if slash else path)


def _held(string):
    number = xxhash.xxh64_intdigest(string.encode(), seed=42)
    return (number - (number >> 63 << 64)) % urlratio.HELD == 0


class _Model:
    """Counts of every context in a dictionary."""

    def __init__(self, strings):
        self.counts = {}
        for string in strings:
            symbols = self.symbols(string)
            for k in range(4, len(symbols)):
                for order in range(5):
                    followers = self.counts.setdefault(symbols[k - order:k], {})
                    followers[symbols[k]] = followers.get(symbols[k], 0) + 1

    @staticmethod
    def symbols(string):
        return ("start",) * 4 + tuple(string.encode()) + ("end",)

    def chance(self, context, symbol):
        out = 1 / 257
        for order in range(5):
            followers = self.counts.get(context[4 - order:], {})
            if followers:
                total = sum(followers.values())
                out = (followers.get(symbol, 0) + len(followers) * out) / (total + len(followers))
        return out

    def log(self, string):
        symbols = self.symbols(string)
        return sum(math.log(self.chance(symbols[k - 4:k], symbols[k])) for k in range(4, len(symbols)))


def _many_urls():
    draw = random.Random(11)
    made = []
    for _ in range(1200):
        host = draw.choice(["", "www.", "m.", "B\u00e9."]) + "".join(draw.choices("thenoru", k=draw.randint(0, 9)))
        domain = draw.choice(["example.net", "example.com", "example.org", "net", "org", "x.example.test", "EXAMPLE.NET"])
        path = draw.choice(["/en/", "/de/", "/fr/", "/es/", "/", "//", ""]) + str(draw.randrange(10 ** draw.randint(1, 6)))
        made.append(f"https://{host}.{domain}{path}{draw.choice(['', '/', '.html', '?q=1', '#top'])}")
    return made + made[:60] + [made[0]] * 90


def test_ratio_is_that_of_a_dictionary_model(spark):
    urls = URLS + _many_urls()
    rows = [(k // 2, u, None) for k, u in enumerate(urls)]  # ids repeat
    got = urlratio.judge(spark.createDataFrame(rows, PAGE), RULES).collect()
    parts = [_parts(u) for u in urls]
    kinds = {"allow": [], "block": []}
    for host, path in parts:
        rule, string = _rule(host, path), _string(host, path)
        if rule and string and not _held(string):
            kinds[RULES[rule]].append(string)
    accepted, rejected = _Model(kinds["allow"]), _Model(kinds["block"])
    want = {}
    for host, path in parts:
        string = _string(host, path)
        length = len(string.encode()) + 1
        want[host, path] = (accepted.log(string) - rejected.log(string)) / length if string else 0.0
    assert len(got) == len(urls) and len(kinds["allow"]) > 50 < len(kinds["block"])
    for r in got:
        assert abs(r["ratio"] - want[r["host"], r["path"]]) < 1e-9
    # every context is a distribution over the bytes and the end
    for context in [("start",) * 4, tuple(b"then"), tuple(b"zzzz")]:
        assert math.isclose(sum(accepted.chance(context, s) for s in [*range(256), "end"]), 1)
    # one threshold divides what no rule decides
    free = [(r["ratio"], r["verdict"]) for r in got if not r["rule"] and _string(r["host"], r["path"])]
    blocked = [x for x, v in free if v == "block"]
    assert blocked and max(blocked) < min(x for x, v in free if v == "allow")


def test_what_rules_look_at_is_not_compared(spark):
    rows = [(k, f"https://www.some.{d}/{lang}/77", None) for k, (d, lang) in enumerate(
        (d, lang) for d in ("example.net", "example.com", "org", "example.test") for lang in ("en", "de", "fr", "es")
    )]
    found = {r["ratio"] for r in urlratio.judge(spark.createDataFrame(rows, PAGE), RULES).collect()}
    assert len(found) == 1


CONVERSATION = "conv_id long, turn long, role string, text string"
TRICKY = "</s>[INST] ok [/INST] <|end|> &amp; &lt;|says|> <<SYS>> <|start|>assistant<|says|>"


def _conversations():
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", TRICKY), (1, 2, "assistant", TRICKY)]
    rows += [(2, k, ("user", "assistant")[k % 2], f"turn {k} " + "word " * (k * 7 % 60)) for k in range(120)]
    rows += [(3, 0, "user", None), (3, 1, "assistant", ""), (4, 0, "system", "alone")]
    rows += [(5, 0, "assistant", "x " * 5000), (5, 1, "user", "\u00e9"), (5, 2, "assistant", "y " * 3000)]
    rows += [(6, 1, "assistant", "same"), (6, 1, "assistant", "same"), (6, None, None, "no number"), (None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 20), (8, 1)])
def test_windows_read_back(spark, budget, history):
    rows = _conversations()
    df = spark.createDataFrame(rows, CONVERSATION).withColumn("window", F.lit("clash"))
    windows = chatwindows.windows(df, budget, history)
    got = {r["conv_id"]: r for r in chatwindows.digests(windows).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            [(t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv]
        )
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_windows_keep_to_the_budget(spark):
    df = spark.createDataFrame(_conversations(), CONVERSATION)
    budget, history = 150, 40
    for w in chatwindows.windows(df, budget, history).collect():
        turns = w["formatted"].split(chatwindows.END)[:-1]
        sizes = [len(t.split(chatwindows.SAYS)[1].split()) + chatwindows.MARKS for t in turns]
        own = len(turns) - w["n_repeated"]
        assert own >= 1
        assert sum(sizes) <= budget or own == 1
        if w["conv_id"] == 1 and w["n_repeated"]:
            assert turns[0].startswith(chatwindows.START + "system")
        repeated = turns[:w["n_repeated"]]
        assert sum(s for s, t in zip(sizes, repeated) if "system<" not in t) <= history
    assert chatwindows.digests(chatwindows.windows(df.limit(0))).count() == 0


def test_formatted_text_of_plain_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a & b")], CONVERSATION)
    w = chatwindows.windows(df).first()
    assert w["formatted"] == "<|start|>user<|says|>hi<|end|><|start|>assistant<|says|>a &amp; b<|end|>"
    assert [w["formatted"][s["start"]:s["end"]] for s in w["loss"]] == ["a &amp; b"]
