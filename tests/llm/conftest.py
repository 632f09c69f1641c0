import random

import pytest

EXTRA = ["doc", "key", "n", "at", "h", "f", "row", "shape", "pattern", "clean", "lines", "component", "_id"]
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rnd, n, line=12):
    """``n`` words in lines and sentences."""
    vocab = ["the", "river", "rose", "slowly", "after", "Rain", "and", "über", "мир", "station", "reads", "höhe", "a", "of", "level"]
    words = [rnd.choice(vocab) + rnd.choice(["", "", "s", "ing", str(rnd.randint(0, 30))]) for _ in range(n)]
    out = ""
    for i, w in enumerate(words):
        out += w + ("." if i % 9 == 8 else "") + ("\n" if i % line == line - 1 else " ")
    return out.strip()


def corpus(seed=3):
    """Documents with copies, near copies, shared passages, junk and edges."""
    rnd = random.Random(seed)
    base = [prose(rnd, rnd.choice([20, 60, 90, 200])) for _ in range(24)]
    texts = list(base)
    texts += [base[0], base[1], base[1]]  # exact copies
    for b in base[2:8]:  # near copies: a few words changed, any case
        ws = b.split(" ")
        for _ in range(rnd.randint(1, 2)):
            ws[rnd.randrange(len(ws))] = "changed"
        texts.append(" ".join(ws))
        texts.append(" ".join(ws).upper())
    passage = prose(rnd, 60)
    texts += [prose(rnd, 40) + "\n" + passage + "\n" + prose(rnd, 30) for _ in range(5)]
    texts += [passage, prose(rnd, 3000), "word " * 400, "a" * 9000, "!!! BUY!! NOW!! " * 40, "it*** is### odd&&& " * 30]
    texts += [None, "", "   \n\t ", "one", "two words", "two words", "three small words", "\x0b\x0c\r\n", "same\n" * 12]
    return list(enumerate(texts, start=1))


ITEMS_TEXT = 40


@pytest.fixture(scope="session")
def docs():
    return corpus()


@pytest.fixture(scope="session")
def tables(spark, scratch, docs):
    """A folder with the edge-case tables, and one with empty ones."""
    out = {}
    for kind in ("edge", "empty"):
        root = f"{scratch}/llm-{kind}"
        rows = docs if kind == "edge" else []
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC_SCHEMA).repartition(3)
        df.write.parquet(f"{root}/documents.parquet")
        rnd = random.Random(9)
        own = [t for _, t in rows if t and len(t.split()) > 40]
        items = [(1, prose(rnd, 30)), (2, " ".join(own[0].split()[5:25])), (3, own[3].upper()), (4, "two words"), (5, None), (6, "..."),
                 (7, " ".join(own[0].split()[5:25])), (8, "three small words"), (None, " ".join(own[4].split()[2:14]))] if own else []
        spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
        labels = [(i, 1, int(bool(t) and "BUY" in t)) for i, t in rows if i % 2] + [(1, 0, None), (2, None, 0), (2, 1, 0)] * bool(rows)
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        urls = [
            None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1?x", "https://www.example.org/en/17#a", "http://a.example.org/en/2",
            "http://example.com/de/", "http://x.com/fr/9", "http://org", "http://org/", "https://m.spamfarm.net/en/1?u=://x.org/", "http://riverstation.net/the/level/22",
            "http://riverstation.net/the/level/22", "http://casinowin.net/river", "http://casino-win.net/", "http://xn--80.net/a%20b", "http://" + "river" * 60 + ".net/", "http://win.net/",
        ] if rows else []
        html = "<html><style>p{}</style><body><p>The river station win farm level " + "river station " * 20 + "</p><script>x()</script></body></html>"
        pages = [(i, u, html if i % 3 else None) for i, u in enumerate(urls)]
        spark.createDataFrame(pages + [(None, "http://river.net/a", "")] * bool(pages), "page_id bigint, url string, html string").write.parquet(f"{root}/pages.parquet")
        out[kind] = root
    return out


@pytest.fixture(scope="session")
def awkward(spark, docs):
    """The edge documents with null and repeated ids and clashing columns."""
    rows = [(i, t) for i, t in docs] + [(None, docs[0][1]), (None, docs[0][1]), (None, None), (1, docs[0][1]), (2, docs[1][1])]
    cols = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], f"doc_id bigint, text string, {cols}").repartition(3)
