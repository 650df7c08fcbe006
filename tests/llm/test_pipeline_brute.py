"""The whole pipeline against plain loops over the same documents."""

import random
import re
from collections import Counter

import corpus_pipeline
from pitwall.llm import language, pieces


def words(text, pattern):
    return re.findall(pattern, (text or "").encode().lower())


def language_kept(rows, learned):
    judge = language.Judge(learned)
    return [r for r in rows if judge(r["text"])[2]]


def boilerplate_gone(rows):
    out = []
    for r in rows:
        pages = {x["text"] or "" for x in rows if x["source"] == r["source"]}
        counts = Counter(line for t in pages for line in set(t.split("\n")))
        kept = [x for x in (r["text"] or "").split("\n") if not (counts[x] > 1 and counts[x] > 0.1 * len(pages))]
        text = None if r["text"] is None else "\n".join(kept)
        out.append(r | {"text": text, "n_chars": None if text is None else len(text)})
    return out


def one_of_a_group(rows):
    sets = []
    for r in rows:
        w = words(r["text"], rb"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)), key=lambda k: rows[k]["doc_id"])
                group[y] = x
    return [r for k, r in enumerate(rows) if top(k) == k]


def clean(rows, items):
    pattern, windows = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", set()
    for text in items:
        w = words(text, pattern)
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        w = words(text, pattern)
        return any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    return [r for r in rows if not hit(r["text"])]


def documents():
    rng = random.Random(12)
    parts = {"en": ["the", "ing", "er", "and", "wh", "tion"], "de": ["sch", "ung", "ich", "ein", "ver", "keit"]}
    names = {g: ["".join(rng.choices(p, k=rng.randint(1, 3))) for _ in range(300)] for g, p in parts.items()}
    rows = []

    def add(lang, source, text):
        rows.append({"doc_id": len(rows), "text": text, "lang": lang, "source": source, "n_chars": None if text is None else len(text)})

    def lines(lang, n):
        return "\n".join(" ".join(rng.choices(names[lang], k=12)) for _ in range(n))

    for k in range(160):
        lang = "de" if k % 3 == 0 else "en"
        menu = "home about contact\n" if k % 4 == 0 else ""
        add(lang, f"site{k % 5}", menu + lines(lang, rng.randint(2, 6)))
    for k in range(40):  # a group of copies, a fifth of its source
        add("en", "site1", rows[1]["text"])
    for k in range(30):  # near copies
        text = rows[rng.randrange(60)]["text"].split(" ")
        text[rng.randrange(len(text))] = rng.choice(names["en"])
        add("en", f"site{k % 5}", " ".join(text))
    items = [" ".join(rng.choices(names["en"], k=14)) for _ in range(6)] + ["short item words", None, ""]
    for k in range(8):
        add("en", f"site{k % 5}", f"{lines('en', 2)}\n{rng.choice(names['en'])} {items[k % 6].upper()} {rng.choice(names['en'])}\n{lines('en', 1)}")
    add("en", "site0", lines("en", 2) + " short item words " + lines("en", 1))
    for text in (None, "", " \n", "12 34", "!!", "Ünï 🙂 " + lines("de", 3), lines("en", 400)):
        add("en", "site2", text)
    rng.shuffle(rows)
    return rows, items


def test_pipeline(spark, tmp_path):
    import sentencepiece

    rows, items = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    learned = language.dictionaries(spark.read.parquet(f"{tmp_path}/documents.parquet").select("text", "lang"))

    first = language_kept(rows, learned)
    second = boilerplate_gone(first)
    third = one_of_a_group(second)
    last = clean(third, items)
    assert len(rows) > len(first) and len(second) > len(third) + 50 and len(third) > len(last) + 5
    assert any(a["text"] != b["text"] for a, b in zip(first, second, strict=True)) and sum(r["text"] == rows[0]["text"] for r in last) <= 1

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {r["doc_id"]: library.encode(r["text"]) for r in last}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(want)
    for i, r in got.items():
        assert (list(r.ids), r.n_tokens) == (want[i], len(want[i])) and r.round_trip
