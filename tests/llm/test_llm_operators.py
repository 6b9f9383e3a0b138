"""The training-data operators against brute force, with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing column names."""

import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from skein.llm import (decontaminate, line_dedup, lm_score, packing, quality_rules, secret_scan, simhash_dups,
                       substring_dedup, token_counts, url_filter)
from tests.llm import brute

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_lines string, row string, h string, key string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with working columns."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "k") for i, t in rows], SCHEMA)


def corpus():
    rnd = random.Random(7)
    vocab = ["alpha", "beta", "gamma", "delta", "Größe", "niño", "écho", "zeta", "eta,", "theta.", "IOTA", "日本"]
    text = lambda n: " ".join(rnd.choice(vocab) + str(rnd.randrange(30)) for _ in range(n))
    rows = [(i, text(rnd.randrange(1, 90)) + "\n" + text(8)) for i in range(40)]
    passage = text(60)
    rows += [(100 + i, text(5) + " " + passage + " " + text(7)) for i in range(6)]
    rows += [(200 + i, rows[3][1]) for i in range(5)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (None, text(30)), (None, None), (5, rows[5][1]), (400, text(9000)),
             (401, "a" * 900), (402, "ab" * 300), (403, "Hello <|endoftext|> e\u0301 it's 12")]
    rows += [(500 + i, " \tShared LINE %d \n" % (i % 3) + text(25)) for i in range(30)]
    return rows


ROWS = corpus()


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://Example.NET/en/1?x#y", "https://a.b.net/x", "http://example.com/de/2",
            "http://x.example.com/DE/2", "ftp://q.org/fr/", "http://org/fr/1", "http://net", "http://net?a=/", "a://b://c/d",
            "http://notexample.net/en/", "http://net/", "http://bad.info/spam/1"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(None, urls[3], 1), (3, urls[3], 1)]
                                  + [(1000 + i, f"http://bad.info/spam/{i}", 1) for i in range(60)]
                                  + [(2000 + i, f"http://good{i % 3}.info/page/{i}", 1) for i in range(60)],
                                  "page_id long, url string, items int")
    labels = spark.createDataFrame([(1000 + i, 0 if i < 50 else None, None) for i in range(60)]
                                   + [(2000 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (2000, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = url_filter.url_filter(pages, labels).collect()
    assert len(got) == len(urls) + 122
    by = {r["page_id"]: r for r in got}
    for i, u in enumerate(urls):
        host, path = brute.hosts_and_paths(u)
        fits = [(v, r) for v, r in url_filter.RULES
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.partition("/")[2])]
        rule = max(fits, key=lambda x: len(x[1]), default=(None, None))
        assert (by[i]["host"], by[i]["path"], by[i]["rule"]) == (host, path, rule[1]), u
        assert by[i]["verdict"] == (rule[0] or ("block" if by[i]["mined"] else "allow"))
    assert by[14]["verdict"] == "block" and by[2001]["verdict"] == "allow"
    # the mined rules against counting all item sets
    labelled = [(u["url"], 1000 <= u["page_id"] < 1050) for u in pages.collect() if (u["page_id"] or 0) >= 1000]
    rules, members = url_filter.mine_rules(spark.createDataFrame(labelled, "url string, bad boolean"))
    cover = {r["item"]: r["cover"] for r in members.collect()}
    for r in rules.collect():
        hits = [bad for u, bad in labelled if set(r["covers"]) <= {cover.get(i) for i in url_filter.url_items(u)}]
        assert r["confidence"] == pytest.approx(sum(hits) / len(hits)) and sum(hits) >= url_filter.MIN_COUNT
    assert url_filter.url_filter(pages.limit(0), labels.limit(0)).count() == 0


def test_url_filter_mines_all_rules(spark):
    """Verdicts equal those of all item sets counted one by one, by the index and by joins."""
    rng = random.Random(3)
    rows = []
    for n in range(120):
        host = rng.choice(["a.example", "b.example", "shop.b.example"])
        rows.append((n, f"http://{host}/{rng.choice(['x', 'y'])}?{rng.choice(['k=1', 'j=1'])}", rng.random() < 0.4))
    rows = [(n, u, bad or "a.ex" in u and "/x" in u or "shop" in u and "j=" in u) for n, u, bad in rows]
    total, bad = len(rows), sum(b for _, _, b in rows)
    items = {n: frozenset(url_filter.url_items(u)) for n, u, _ in rows}
    count, count_bad = Counter(), Counter()
    for n, _, is_bad in rows:
        for size in range(1, len(items[n]) + 1):
            for key in itertools.combinations(sorted(items[n]), size):
                count[key] += 1
                count_bad[key] += is_bad
    able = {frozenset(k): count_bad[k] / c for k, c in count.items()
            if count_bad[k] >= 8 and count_bad[k] / c >= max(0.6, 1.2 * bad / total)}
    rules = {k: s for k, s in able.items() if not any(p < k and t >= s for p, t in able.items())}
    assert rules
    want = {n: min(((-s, sorted(k)) for k, s in rules.items() if k <= items[n]), default=None) for n in items}
    pages = spark.createDataFrame([(n, u) for n, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(n, int(not b), 0) for n, _, b in rows], "doc_id long, quality int, toxic int")
    for most in (url_filter.BROADCAST_RULES, 0):
        got = url_filter.url_filter(pages, labels, rules=[], min_support=0.0, min_lift=1.2, min_count=8, broadcast_rules=most)
        assert {r["page_id"]: r["mined"] for r in got.collect()} == {
            n: " & ".join(w[1]) if w else None for n, w in want.items()}


def test_url_filter_mines_long_urls(spark):
    """Pages of one site share two dozen items, all true together: one set, not all their choices."""
    path = "/".join(f"part{i}-of{i}" for i in "abcdefghij")
    urls = [(n, f"http://www.shop.example.org/{path}/{n}") for n in range(200)]
    urls += [(n, f"http://h{n}.example.net/{n}") for n in range(200, 300)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(n, int(n >= 200), 0) for n, _ in urls], "doc_id long, quality int, toxic int")
    got = url_filter.url_filter(pages, labels, rules=[]).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"block": 200, "allow": 100}


def test_url_filter_reads_every_token(spark):
    assert set(url_filter.url_items("http://www.casino-win.a.org/x/y/cheap-pills7/?id=1&bad=2&id=3")) >= {
        "part=www", "part=casino-win", "part=a", "path3=cheap-pills0", "word=cheap", "word=pills0", "key=id", "key=bad"}
    # bad pages have one thing in common: a middle label, a segment, a word of a segment or a query key
    kinds = ["http://h{i}.casino-win.a{i}.org/", "http://h{i}.org/p{i}/q{i}/spam", "http://h{i}.org/p/q/r{i}x-pills-y{i}x",
             "http://h{i}.org/?k{i}=1&bad=2"]
    # letters in place of digits, so that no two pages share more
    name = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    for kind in kinds:
        urls = [(n, kind.replace("{i}", name(n))) for n in range(40)]
        urls += [(n, f"http://h{name(n)}.net/good{name(n)}") for n in range(100, 140)]
        urls += [(999, kind.replace("{i}", "new"))]
        pages = spark.createDataFrame(urls, "page_id long, url string")
        labels = spark.createDataFrame([(n, int(n >= 100), 0) for n, _ in urls[:-1]], "doc_id long, quality int, toxic int")
        got = url_filter.url_filter(pages, labels, rules=[]).filter("page_id = 999").first()
        assert got["verdict"] == "block", kind


def test_line_dedup(spark):
    got = line_dedup.line_dedup(frame(spark, ROWS), 5).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got), key=key) == sorted(
        brute.line_dedup(ROWS, 5), key=key)
    assert got[0]["h"] == "z" and any(r["n_dropped"] for r in got)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_quality_rules(spark):
    good = "\n".join(f"This is sentence number {i} of a plain text about rivers {i * 7}." for i in range(10))
    cases = {0: good, 1: None, 2: "", 3: "too short.", 4: "spam eggs ham " * 60, 5: good.replace(" ", "%%% "),
             6: good + "\nHome | News | Sport | Weather | Contact", 7: good.replace(" ", " | "),
             8: good + "\nAll rights reserved. Accept all cookies", 9: good.replace(" ", "!! ")}
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(frame(spark, cases.items())).collect()}
    assert {i for i, r in got.items() if r["kept"]} == {0, 6, 8}
    assert got[6]["clean_text"] == good and got[8]["clean_text"] == good and got[0]["n_lost"] == 0
    kept = quality_rules.apply_quality(frame(spark, cases.items()))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(0, good), (6, good), (8, good)]
    assert kept.columns == ["doc_id", "text", "n_lines", "row", "h", "key"]
    for (i, text), r in zip(ROWS, quality_rules.quality_rules(frame(spark, ROWS).coalesce(1)).collect(), strict=True):
        w = brute.words(text, lower=False)
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        twice = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)} if len(w) < 2000 else None
        assert (r["doc_id"], r["n_words"], r["word_chars"]) == (i, len(w), sum(map(len, w)))
        assert twice is None or r["n_repeat_words"] == len(twice)
    assert quality_rules.apply_quality(frame(spark, [])).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    rows = [(n, t) for n, (_, t) in enumerate(ROWS)]
    ids = {n: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for n, t in rows}
    for window in (4096, 64):
        got = packing.pack(frame(spark, rows).repartition(3), BPE, window).collect()
        covered, placed = {}, {}
        for r in got:
            data = np.frombuffer(r["ids"], "<u4").tolist()
            assert data == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]] and len(data) == r["length"] > 0
            assert r["doc_tokens"] == len(ids[r["doc_id"]])
            covered.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
            placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for spans, total in [*((s, len(ids[n])) for n, s in covered.items()), *((s, None) for s in placed.values())]:
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at == total if total is not None else at <= window
        assert len(covered) == len(rows)
        assert sum(window - sum(n for _, n in s) for s in placed.values()) < window  # the last one only
    assert packing.pack(frame(spark, []), BPE).count() == 0


def test_packing_plan_fills_exactly():
    rnd = np.random.default_rng(3)
    histogram = np.bincount(rnd.integers(1, 256, 5000), minlength=256)
    used = np.zeros(256, np.int64)
    for a, m, b, r in packing.plan(histogram, 256):
        assert m * a + b == 256 and r > 0
        used[a] += m * r
        used[b] += r if b else 0
    assert (used <= histogram).all() and used.sum() > 0.8 * histogram.sum()


def test_secret_scan(spark):
    secret = "s3cR3t-Zx81kQp0"
    cases = {0: f'db_password = "{secret}"', 1: f'K = "{secret}"\nclient.api_key = K\n', 2: f"apiToken: ${{HIDDEN}}\nHIDDEN={secret}",
             3: 'password_length = "12345678"', 4: 'greeting = "Zx81kQp0-s3cR3t"', 5: None, 6: "", 7: "Note: plain prose = fine",
             8: "é" * 3 + " token = 0123456789abcdef0123456789abcdef AKIAABCDEFGHIJKL", 9: 'password = "changeme-example"',
             10: "ſecret=12345678 api_\u212aey=12345678 PASSWD:short"}
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
           for r in secret_scan.secret_scan(frame(spark, cases.items())).collect()}
    literal = lambda i: [cases[i][s:e] for k, s, e in got[i] if k == "literal"]
    assert literal(0) == literal(1) == literal(2) == [secret]
    assert not any(literal(i) for i in (3, 4, 7, 9)) and got[5] == got[6] == got[7] == got[10] == []
    assert got[8][:1] == [("assign", 4, 44)] and {k for k, *_ in got[8]} >= {"assign", "hex", "access"}
    assert [k for k, *_ in got[1]] == ["literal"]
    # a long chain of names, and a ring: the literal is reached through all of them
    chain = "".join(f"v{'x' * (i % 7)}{chr(97 + i // 7 % 26)} = v{'x' * ((i + 1) % 7)}{chr(97 + (i + 1) // 7 % 26)}\n" for i in range(181))
    text = f"api_secret = va\nring = api_secret\nva = ring\n{chain}v{'x' * (181 % 7)}{chr(97 + 181 // 7 % 26)} = '{secret}'"
    assert [text[s:e] for s, e in secret_scan.literal_spans(text)] == [secret]
    assert secret_scan.secret_scan(frame(spark, [])).count() == 0


def test_quality_counts_and_verdict_equal_brute_force(spark):
    """All counts, base_failed and the verdict on mixed texts, rule by rule."""
    rng = random.Random(5)
    words = ["river", "stone", "Größe", "niño", "a#b", "$5", "|", "<x>", "y%", "écho", "note"]
    lines = ["", "  ", "Alle Rechte vorbehalten", "Mehr lesen", "Home | News | About", "!!! ??? !!!", "repeat this line of words twice",
             "Read  more", "En savoir plus", "Todos los derechos reservados \u00a9 2020"]
    rows = [(1, None), (2, ""), (3, " \n\t ")]
    for n in range(4, 90):
        text = [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) if rng.random() < 0.6 else rng.choice(lines)
                for _ in range(rng.randrange(1, 12))]
        rows.append((n, "\n".join(text)))
    visible = lambda t: len(t.encode().translate(None, b" \t\n\x0b\x0c\r"))
    kept = 0
    for r in quality_rules.quality_rules(frame(spark, rows)).collect():
        text = dict(rows)[r["doc_id"]] or ""
        parts = [x.encode() for x in text.encode().decode().split("\n")]
        w = [x for x in text.encode().split()]
        win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        again = {i + k for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for k in range(8)}
        full = [x for x in parts if x.split()]
        want = (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(again))
        assert tuple(r[c] for c in quality_rules.COUNTS) == want, text
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        stay = [x for x in parts if not quality_rules.line_fails(x)]
        lost = visible(text) - sum(visible(x.decode()) for x in stay)
        assert r["kept"] == (not r["base_failed"] and 2 * lost <= visible(text)), text
        kept += r["kept"]
        if lost:
            assert r["clean_text"] == b"\n".join(stay).decode()
    assert 5 < kept < 80


def test_quality_phrases_count_by_share():
    fails = lambda t, *p: quality_rules.line_fails(t.encode(), *p)
    for line in ("Alle Rechte vorbehalten", "Mehr lesen", "EN SAVOIR PLUS", "TOUS DROITS R\u00c9SERV\u00c9S", "Read\tmore", "Log in",
                 "Todos los derechos reservados", "Datenschutzerkl\u00e4rung", "\u00a92024 Firma", "Click here to read more"):
        assert fails(line) == "boilerplate", line
    prose = ("In the long winter evenings the teacher asked us to read more books than we could carry home and we sat by the "
             "stove with them until the lamp went out each night")
    assert fails(prose) is None and quality_rules.clean_lines(prose.encode()) == (prose.encode(), len(prose.replace(" ", "")), 0)
    for line in ("He is the breadmore of the town", "signing in the rain", "", "   "):
        assert fails(line) is None, line
    own = quality_rules.Phrases({"nl": ("lees meer",)})
    assert fails("Lees meer", own) == "boilerplate" and fails("Read more", own) is None and fails("Lees meer") is None
    assert fails("Read more", None) is None and fails("Read more", quality_rules.Phrases({})) is None


SYNTAX = [
    'token: str = "{}"', 'cfg["pwd"] = "{}"', "cfg[ 'pwd' ]='{}'", 'api_key = b = "{}"', 'x = "{}"\npassword = f"{{x}}"',
    'password = """{}"""', "pwd = r'{}'", "pwd: |\n  {}\nnext: 1", "- pwd: >-\n    {}", "<pwd>{}</pwd>", '<pwd kind="a">\n {} </pwd>',
    'client.set_password("{}")', 'client.setPassword("{}")', 'password.set("{}")', 'x.put("pwd", "{}")', 'define("DB_PASSWORD", "{}");',
    'pwd = os.getenv("X", "{}")', "PWD=${{X:-{}}}", 'pwd = os.environ["Q"]\nQ={}', '<add key="pwd" value="{}"/>',
    'connect(user="me", password="{}")', 'var secretToken string = "{}"', 'const token: string | null = "{}"', 'pwd = a or "{}"',
    'pwd = a ?? "{}"', '{{"pwd":"{}"}}', 'pwd = SecretStr("{}")', 'K = "{}"\nclient.api_key = K\n', "export PWD={}", "pwd => '{}'"]


def test_secret_scan_reads_syntax():
    secret = "s3cR3t-Zx81kQp0"
    for kind in SYNTAX:
        text = kind.format(secret)
        assert [text[s:e] for s, e in secret_scan.literal_spans(text)] == [secret], kind
        harmless = text
        for name in ("api_key", "pwd", "PWD", "password", "Password", "PASSWORD", "secretToken", "token"):
            harmless = harmless.replace(name, "title")
        assert secret_scan.literal_spans(harmless) == [], harmless
    for text in ('pwd = "s3cR3t-" + "Zx81kQp0"', "pwd = 's3cR3t-' 'Zx81kQp0'", 'pwd = ("s3cR3t-"\n  "Zx81kQp0")',
                 'pwd = f"s3cR3t-{x}Zx81kQp0"', 'pwd = "s3cR3t-" . "Zx81kQp0"'):
        assert [text[s:e] for s, e in secret_scan.literal_spans(text)] == ["s3cR3t-", "Zx81kQp0"], text
    for text in ("", "=", "pwd =", "pwd: |\n", "pwd: (", 'pwd["', "pwd = ${", 'pwd = """', "<pwd></pwd>", "set_pwd(''"):
        assert secret_scan.literal_spans(text) == [], text


def test_secret_scan_base_kinds_equal_brute_force():
    """The three base kinds on random texts, character by character."""
    rng = random.Random(11)
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def runs(text, at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    def assign_at(text, at):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text[at:at + 8])
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not low.startswith(word):
                continue
            p = at + len(word)
            p += text[p:p + 1] in ('"', "'") and p < len(text)
            p = runs(text, p, " ")
            if text[p:p + 1] not in (":", "=") or p >= len(text):
                continue
            p = runs(text, p + 1, " ")
            p += text[p:p + 1] in ('"', "'") and p < len(text)
            end = runs(text, p, value)
            if end > p:
                return p, end
        return None

    def brute_spans(text):
        out, at = [], 0
        while at < len(text):
            if m := assign_at(text, at):
                if m[1] - m[0] >= 8:
                    out.append((at, m[1], "assign"))
                at = m[1]
            else:
                at += 1
        at = 0
        while at < len(text):
            end = runs(text, at + 4, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")) if text[at:at + 4] == "AKIA" else at
            if end > at + 4:
                if end - at >= 16:
                    out.append((at, end, "access"))
                at = end
            else:
                at += 1
        at = 0
        while at < len(text):
            end = runs(text, at, set("0123456789abcdef"))
            if end - at >= 32:
                out.append((at, end, "hex"))
            at = max(end, at + 1)
        return out

    pieces = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "api-key", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIAAKIA",
              "ABCDEFGH1234", "abcdef01", "0123456789abcdef", "=+/", "\u017f", "\u212a", "\n", "\t", "é", "x", "deadbeef" * 4]
    found = 0
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert sorted(secret_scan.base_spans(text)) == sorted(brute_spans(text)), repr(text)
        found += len(brute_spans(text))
    assert found > 300


def test_secret_scan_reads_long_names():
    secret = "s3cR3t-Zx81kQp0"
    for n in (1, 100, 128, 140, 5000, 1_000_000):
        text = f"{'a' * n}.pwd = '{secret}'\n"
        assert [text[s:e] for s, e in secret_scan.literal_spans(text)] == [secret], n
    assert secret_scan.literal_spans("a.b-" * 500_000 + " x = 1") == []


@pytest.mark.parametrize("block", [1 << 13, 4])
def test_simhash(spark, block):
    near = ROWS[0][1]
    rows = [*ROWS, (900, near), (901, near + " tail"), (902, near.replace("alpha", "omega", 1))]
    got = simhash_dups.simhash_dups(frame(spark, rows), 3, 6, block=block, max_blocks=1 << 11).collect()
    fps = sorted((brute.simhash(t), -1 if i is None else i) for i, t in rows)
    assert sorted((r["fp"] % (1 << 64), -1 if r["doc_id"] is None else r["doc_id"]) for r in got) == fps
    roots = brute.groups([f for f, _ in fps], 6)
    least = {}
    for (_, i), g in zip(fps, roots, strict=True):
        if i >= 0:
            least[g] = min(least.get(g, i), i)
    want = sorted((i, least.get(g, -1)) for (_, i), g in zip(fps, roots, strict=True))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], -1 if r["component_id"] is None else r["component_id"])
                  for r in got) == want
    kept = simhash_dups.apply_simhash(frame(spark, rows), 3, 6, block=block).collect()
    assert len(kept) == len(set(roots)) and kept[0]["h"] == "z"
    assert simhash_dups.apply_simhash(frame(spark, [])).count() == 0


def test_trie_walk_finds_every_pair():
    rnd = np.random.default_rng(1)
    a = np.unique(rnd.integers(0, 1 << 9, 300).astype(np.uint64) << np.uint64(20))
    b = np.unique(rnd.integers(0, 1 << 9, 300).astype(np.uint64) << np.uint64(20))
    for x, y in ((a, None), (a, b)):
        found = {(int(i), int(j)) for u, v in simhash_dups.walk(x, y, 2) for i, j in zip(u, v, strict=True)}
        other = x if y is None else y
        want = {(i, j) for i in range(len(x)) for j in range(len(other))
                if int(x[i] ^ other[j]).bit_count() <= 2 and (y is not None or i < j)}
        assert found == want


def test_cut_of_the_trie_meets_every_pair_of_subtrees():
    rnd = np.random.default_rng(2)
    for _ in range(40):
        cut, todo = [], [(0, 0)]
        while todo:
            d, p = todo.pop()
            if d == 8 or (d > 1 and rnd.random() < 0.3):
                cut.append((d, p))
            else:
                todo += [(d + 1, 2 * p + i) for i in (0, 1) if rnd.random() < 0.9]
        cut.sort(key=lambda c: c[1] << (64 - c[0]))
        lows = np.array([p << (64 - d) for d, p in cut], np.uint64)
        depths = np.array([d for d, _ in cut], np.int64)
        mine = np.arange(0, len(cut), 2)
        for bits in (0, 2, 3):
            owner, other = simhash_dups.cut_partners(lows, depths, mine, bits)
            want = set()
            for i in mine.tolist():
                for j, (d, p) in enumerate(cut):
                    m = min(d, cut[i][0])
                    if ((cut[i][1] >> (cut[i][0] - m)) ^ (p >> (d - m))).bit_count() <= bits:
                        want.add((i, j))
            pairs = list(zip(mine[owner].tolist(), other.tolist(), strict=True))
            assert len(pairs) == len(want) and set(pairs) == want


def test_subtrees_hold_a_bounded_number_at_any_input(spark):
    rnd = np.random.default_rng(3)
    values = np.unique(np.concatenate([rnd.integers(0, 1 << 63, 500), rnd.integers(0, 1 << 20, 1500)]).astype(np.int64))
    nodes = spark.createDataFrame([(int(v),) for v in values], "fp long")
    cut = simhash_dups.trie_cut(nodes, 1, 4, 50)
    lows = np.array([p << (64 - d) for d, p in cut], np.uint64)
    ends = np.array([(p + 1 << (64 - d)) - 1 for d, p in cut], np.uint64)
    inside = (values.view(np.uint64)[:, None] >= lows) & (values.view(np.uint64)[:, None] <= ends)
    assert (inside.sum(1) == 1).all() and 1 <= inside.sum(0).min() and inside.sum(0).max() <= 50


def test_decontaminate(spark):
    long_doc = ROWS[47][1]
    items = [(1, " ".join(ROWS[41][1].split()[6:40])), (2, "alpha1 BETA2"), (3, None), (4, "?!"), (None, ROWS[0][1]),
             (5, long_doc), (5, long_doc), (10, "日本1"), (11, "never seen words here at all")]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.decontaminate(frame(spark, ROWS), bench).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted(brute.decontaminate(ROWS, items, 13), key=key)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=key) == want
    bad = [r for r in want if r[2] and 20 * r[2] >= r[1]]
    left = decontaminate.apply_decontamination(frame(spark, ROWS), bench)
    assert left.count() == len(ROWS) - len(bad) and left.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert decontaminate.decontaminate(frame(spark, ROWS), bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("max_words", [1 << 18, 40])
def test_lm_score(spark, max_words):
    rows = [(n, t) for n, (_, t) in enumerate(ROWS)]
    got = {r["doc_id"]: r for r in lm_score.lm_score(frame(spark, rows), max_words=max_words).collect()}
    want, n = brute.unigrams(rows, brute.training)
    for i, (tokens, known, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["held_out"] == (not brute.training(i))
        assert r["base_score"] == pytest.approx(score, rel=1e-9) and r["score"] < 0
    assert lm_score.lm_score(frame(spark, [])).count() == 0


def test_lm_learns_word_order(spark):
    rnd = random.Random(5)
    follow = {w: rnd.sample(range(200), 3) for w in range(200)}

    def text():
        w, out = rnd.randrange(200), []
        for _ in range(60):
            w = rnd.choice(follow[w])
            out.append(f"w{w}")
        return " ".join(out)
    rows = [(i, text()) for i in range(1500)]
    got = lm_score.lm_score(frame(spark, rows)).filter("held_out").collect()
    assert sum(r["score"] for r in got) > 0.8 * sum(r["base_score"] for r in got)  # both are negative


@pytest.mark.parametrize("max_words", [1 << 18, 40, 0])
@pytest.mark.parametrize("filter_bits", [27, 13, 3])
def test_lm_scores_do_not_depend_on_the_filter(spark, filter_bits, max_words):
    rows = [(n, t) for n, (_, t) in enumerate(ROWS)]
    want = brute.bigrams(rows, brute.training, lm_score.PRIOR, lm_score.MIDDLE)
    got = {r["doc_id"]: r["score"] for r in
           lm_score.lm_score(frame(spark, rows), filter_bits=filter_bits, max_words=max_words, flush_bytes=20_000,
                             shard_bytes=5_000).collect()}
    # 2**27 bits hold all n-grams, 2**3 bits none; 2**13 are crowded, with false positives
    assert got == {i: pytest.approx(x, rel={27: 1e-3, 13: 3e-2, 3: 1e-9}[filter_bits]) for i, x in want.items()}


def test_lm_pairs_seen_once_count(spark):
    # every pair is seen once in training; the words of all three held-out texts are equally frequent
    ids = iter(range(10_000))
    learnt, asked = [], []
    while len(learnt) < 1 or len(asked) < 3:
        i = next(ids)
        if brute.training(i) and len(learnt) < 1:
            learnt.append(i)
        elif not brute.training(i) and len(asked) < 3:
            asked.append(i)
    rows = [(learnt[0], "a b c d"), (asked[0], "a b c d"), (asked[1], "c a d b"), (asked[2], "e f g h")]
    score = {r["doc_id"]: r["score"] for r in lm_score.lm_score(frame(spark, rows)).collect()}
    assert score[asked[0]] > score[asked[1]] + 1e-9 and score[asked[1]] > score[asked[2]] + 1e-9


def test_token_counts(spark):
    vocabulary = {p for p in token_counts.load_pieces(PIECES)}
    got = token_counts.token_counts(frame(spark, ROWS).coalesce(1), PIECES).collect()
    for (i, text), r in zip(ROWS, got, strict=True):
        each = [brute.pieces(token_counts.MARK + w.encode(), vocabulary) for w in brute.words(text, lower=False)]
        assert (r["doc_id"], r["n_words"], r["n_tokens"]) == (i, len(each), sum(each))
    assert token_counts.token_counts(frame(spark, []), PIECES).count() == 0


def test_automaton_is_greedy():
    rnd = random.Random(2)
    for _ in range(200):
        vocabulary = {bytes(rnd.choices(b"abc", k=rnd.randrange(1, 6))) for _ in range(8)}
        automaton = token_counts.Automaton(vocabulary)
        for _ in range(20):
            data = bytes(rnd.choices(b"abcd", k=rnd.randrange(0, 15)))
            assert automaton.count(data) == brute.pieces(data, vocabulary)


@pytest.mark.parametrize("batch_bytes", [32 << 20, 2000])
def test_substring_dedup(spark, batch_bytes):
    rows = [(n, t) for n, (_, t) in enumerate(ROWS)] + [(0, ROWS[0][1])]
    want = brute.substring_dedup([(i, (t or "").encode()) for i, t in rows[:-1]], 100)
    got = substring_dedup.substring_dedup(frame(spark, rows).repartition(4), batch_bytes=batch_bytes).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]), [tuple(x) for x in r["removed"]]) for r in got) == sorted([*want, want[0]])
    assert any(r["n_removed"] for r in got)
    nulls = substring_dedup.substring_dedup(frame(spark, [(None, ROWS[0][1]), (1, ROWS[0][1])])).collect()
    assert {r["doc_id"]: r["n_removed"] > 0 for r in nulls} == {None: False, 1: True}
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0


def test_substring_dedup_spreads_an_anchor_with_many_spans(spark):
    # one passage in many documents, in surroundings that all differ: the spans at its edges share two anchors
    rnd = random.Random(3)
    noise = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = noise(600)
    rows = [(i, noise(150) + passage + noise(150)) for i in range(200)]
    texts = substring_dedup._narrow(frame(spark, rows).repartition(4), "doc_id", "text")
    every = np.full(1 << 4, -1, np.int64).view(np.uint64)  # lets all anchors pass
    found = substring_dedup.start_batches(texts, every, every, 10, 64, 100, 32, 1 << 30).filter("kind = 0").collect()
    sizes = {}
    for r in found:
        sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + len(r["data"])
    assert len(sizes) == 64 and max(sizes.values()) < 2 * sum(sizes.values()) / 64
    want = brute.substring_dedup([(i, t.encode()) for i, t in rows], 100)
    for batch_bytes, spread in ((32 << 20, 256), (32 << 20, 20), (20_000, 1)):
        got = substring_dedup.substring_dedup(frame(spark, rows).repartition(4), batch_bytes=batch_bytes,
                                              spread=spread).collect()
        assert sorted((r["doc_id"], bytes(r["kept"]), [tuple(x) for x in r["removed"]]) for r in got) == sorted(want)
