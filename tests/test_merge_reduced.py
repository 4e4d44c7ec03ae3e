import random

from qaloom.operators import merge

SCHEMA = (
    "source_file string, chunk_index int, total_chunks int, qa_pairs array<struct<question string, answer string>>, key_concepts array<string>, "
    "technical_details struct<materials array<string>, parameters array<string>, methods array<string>>, main_findings array<string>"
)


def odd_records(seed):
    """Missing lists and values, empty ones, values with the separator, records of equal place, a source without a name."""
    rng = random.Random(seed)

    def some():
        return rng.choice([None, [], [rng.choice([None, "", "a", "b", "ä", "a\0b", "\0", "c d", "long value " * 9]) for _ in range(rng.randrange(7))]])

    rows = []
    for source in [None, "", "s", *[f"d{k}" for k in range(30)]]:
        for _ in range(rng.choice([1, 2, 9])):
            pairs = rng.choice([None, [], [rng.choice([None, (rng.choice(["q", None]), "x")]) for _ in range(rng.randrange(4))]])
            rows.append((source, rng.choice([-1, 0, 0, 1, 2, 7]), 9, pairs, some(), rng.choice([None, (some(), some(), some())]), some()))
    rng.shuffle(rows)
    return rows


def least(x):
    """Orders as Spark does: missing first, then by bytes, field by field."""
    return (0,) if x is None else (1, tuple(least(f) for f in x) if isinstance(x, tuple) else x.encode())


def by_hand(rows):
    out = {}
    for source in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == source]

        def placed(pick):
            found = [((r[1], i, least(v)), v) for r in mine for i, v in enumerate(pick(r) or [])]
            return [v for _, v in sorted(found, key=lambda x: x[0])]

        lists = [lambda r: r[4], *[lambda r, k=k: r[5] and r[5][k] for k in range(3)]]
        out[source] = (placed(lambda r: r[3]), placed(lambda r: r[6]), *[list(dict.fromkeys(placed(pick))) for pick in lists])
    return out


def merged(df):
    out = {}
    for r in merge.merge_chunk_knowledge(df).collect():
        d = r.technical_details
        assert r.source_file not in out
        out[r.source_file] = ([p and tuple(p) for p in r.qa_pairs], r.main_findings, r.key_concepts, d.materials, d.parameters, d.methods)
    return out


def test_odd_records_match_brute_force(spark):
    for seed, parts in ((1, 1), (2, 5)):
        rows = odd_records(seed)
        assert merged(spark.createDataFrame(rows, SCHEMA).repartition(parts)) == by_hand(rows)


def test_records_are_read_once_and_meet_in_one_shuffle(spark):
    df = spark.createDataFrame(odd_records(3), SCHEMA)
    plan = merge.merge_chunk_knowledge(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_what_is_shuffled_is_reduced_before(spark):
    rows = [("s", i, 900, [], ["a", "b"], (["m"] * 40, [], []), []) for i in range(900)]
    parts = merge._reduced(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert len(parts) == 1 and parts[0].key_concepts_joined == "a\0b" and parts[0].materials_joined == "m" and len(parts[0]["items"]) == 900
