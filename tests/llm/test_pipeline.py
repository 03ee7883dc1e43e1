"""Each stage of the pipeline against a brute-force version of its decisions, on planted cases and odd rows."""

import random

import pytest

pytest.importorskip("yearloom.llm.queries")
pipeline = pytest.importorskip("corpus_pipeline")

from test_llm import check_packing, linked, recurring_lines, rows  # noqa: E402
from yearloom.llm import decontamination  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    r = random.Random(12)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9))) for _ in range(900)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    foul = [f"foul{c}x" for c in "abcdefgh"]
    items = {i: " ".join(say(20)) for i in range(6)}
    texts, toxic, leaking = {}, set(), set()
    for i in range(400):
        parts = [say(40), say(40), say(30)]
        if i % 8 == 0:
            parts[i // 8 % 3][5:20] = [r.choice(foul) for _ in range(15)]
            toxic.add(i)
        lines = [" ".join(p) for p in parts]
        if i % 5 == 1:
            lines.insert(1, f"Stored in the archive by {r.choice(words)}{i}y and friends")
        if i % 5 == 2:
            lines.insert(2, f"Stored in the archive for {r.choice(words)} of {r.choice(words)}")
        if i % 7 == 3:
            lines.append("Share this page")
        if i % 50 == 9:
            lines[0] += " " + items[i % 6].replace("a", "e", 1).upper()
            leaking.add(i)
        texts[i] = "\n".join(lines)
    for i in range(30):  # copies, exact and near
        texts[500 + i] = texts[17] if i % 2 else texts[17] + " " + " ".join(say(3))
        texts[600 + i] = " ".join([*texts[33].split(" ")[:-4], *say(4)])
    odd = [(700, None), (701, ""), (702, "  \n \n"), (703, "tiny"), (704, " ".join(say(30_000))), (705, "tiny"), (None, "no id here, none at all"), (1, texts[1]), (1, texts[1]), (706, texts[6]), (2, "other words under an id that is taken " + " ".join(say(20)))]
    data = [(i, t, "en", "web", None if t is None else len(t)) for i, t in [*texts.items(), *odd]]
    folder = tmp_path_factory.mktemp("planted")
    save = lambda rows_, schema, name: spark.createDataFrame(rows_, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    save(data, SCHEMA, "documents")
    save([(i, 1, int(i in toxic)) for i in range(400) if i % 3], "doc_id long, quality int, toxic int", "labels")
    save([*items.items(), (90, None), (91, "")], "item_id long, text string", "benchmark")
    return str(folder), toxic, leaking, items


def pairs(df):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect())


def test_stages(spark, planted):
    sf_dir, toxic, leaking, items = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    kept = STAGES["toxicity"](spark, docs, sf_dir).checkpoint()
    assert kept.columns == docs.columns
    assert pairs(kept) == [x for x in pairs(docs) if not (x[0].isdigit() and int(x[0]) in toxic)]

    lined = STAGES["line dedup"](spark, kept, sf_dir).checkpoint()
    own = [r.asDict() for r in kept.collect()]
    # Rows of one id count as one document here; those of the fixture hold no line that recurs but the first one's.
    going = recurring_lines({r["doc_id"]: r["text"] for r in own if r["doc_id"] is not None and not (r["text"] or "").startswith("other words")})
    want = []
    for r in own:
        gone = going.get(r["doc_id"], set())
        t = r["text"]
        want.append((str(r["doc_id"]), str("\n".join(x for x in t.split("\n") if x not in gone) if t is not None and gone else t)))
    assert lined.columns == docs.columns and pairs(lined) == sorted(want) and sum(map(bool, going.values())) > 100
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in lined.collect())

    single = STAGES["near dedup"](spark, lined, sf_dir).checkpoint()
    own = sorted((r.asDict() for r in lined.where("doc_id IS NOT NULL").collect()), key=lambda r: (r["doc_id"], str(r["text"])))
    label = linked([("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")) for r in own])
    # Rows that share an id are linked through it.
    least, again = {}, True
    while again:
        again = False
        for k, r in enumerate(own):
            for key in ("id", r["doc_id"]), ("set", label[k]):
                best = min(least.get(("id", r["doc_id"]), r["doc_id"]), least.get(("set", label[k]), r["doc_id"]))
                if least.get(key) != best:
                    least[key], again = best, True
    want = sorted({(str(r["doc_id"]), str(r["text"])) for r in own if least["id", r["doc_id"]] == r["doc_id"]} | {("None", "no id here, none at all")})
    assert single.columns == docs.columns and pairs(single) == want

    clean = STAGES["decontamination"](spark, single, sf_dir).checkpoint()

    def leaks(text):
        body = decontamination.normal(text)
        for item in items.values():
            item = decontamination.normal(item)
            row = [0] * (len(body) + 1)
            for i, c in enumerate(item, 1):
                new = [i]
                for j, t in enumerate(body, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
                row = new
            if min(row) <= int(decontamination.ERROR_RATE * len(item)):
                return True
        return False

    # Of the other texts a sample is put to the full comparison, which takes long.
    went = set(pairs(single)) - set(pairs(clean))
    assert clean.columns == docs.columns and {int(i) for i, _ in went} == {i for i in leaking if i not in toxic and str(i) in {x[0] for x in pairs(single)}}
    assert went and all(leaks(t) for _, t in sorted(went)[:3]) and not any(leaks(t) for _, t in pairs(clean)[:12] if len(t) < 2000)

    packed = rows(STAGES["packing"](spark, clean.where("doc_id IS NOT NULL AND doc_id <> 2"), sf_dir))
    check_packing(packed, {r["doc_id"]: r["text"] for r in clean.collect() if r["doc_id"] not in (None, 2)})


def test_stages_on_an_empty_table(spark, planted):
    sf_dir = planted[0]
    none = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        out = stage(spark, none, sf_dir)
        assert out.count() == 0 and (name == "packing" or out.columns == none.columns)


def test_clashing_columns(spark, planted):
    sf_dir = planted[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    for name in ("toxic_score", "n_lines", "kept", "leaks", "_kept", "node", "template"):
        docs = docs.withColumn(name, docs["lang"])
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert sorted(out.columns) == sorted(docs.columns) and out.count() > 0, name


def test_run(spark, planted):
    assert pipeline.run(spark, planted[0]).count() > 200
