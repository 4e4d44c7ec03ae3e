import re
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from qaloom.operators.prompts import PromptRegistry
from qaloom.plans.flows import text_to_qa

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REGISTRY = PromptRegistry(
    {
        9: "KNOW {source_file}{chunk_label}: {chunk}",
        43: "ASK factual {source_file} {qa_context}",
        44: "ASK comparison {source_file} {qa_context}",
        45: "ASK reasoning {source_file} {qa_context}",
        46: "ASK open_ended {source_file} {qa_context}",
    }
)


def stub(sent):
    def factory():
        def client(prompt):
            sent.add(1)
            if prompt.startswith("KNOW"):
                words = re.findall("w[0-9]+", prompt)
                concepts = ", ".join(f'"{w}"' for w in sorted(set(words)))
                return '```json\n{"qa_pairs": [], "key_concepts": [%s], "main_findings": ["f"]}\n```' % concepts
            if prompt.startswith("ASK"):
                _, kind, source = prompt.split(" ")[:3]
                typed = "" if kind == "factual" else ', "question_type": "given"'
                return '```json\n{"qa_pairs": [{"question": "%s %s?", "answer": "a"%s}]}\n```' % (kind, source, typed)
            if prompt.startswith("ANSWER"):
                return "mine"
            return "-1" if "reasoning" in prompt else "1"

        return client

    return factory


def test_documents_to_judged_pairs(spark):
    long_text = " ".join(f"w{i % 7} some filler words." for i in range(300))
    docs = [("a.txt", "short w1"), ("b.txt", long_text), ("blank.txt", " \n"), ("c.txt", "w2 w3"), ("d.txt", "w4")]
    sent = spark.sparkContext.accumulator(0)
    out = text_to_qa(
        spark.createDataFrame(docs, "source_file string, content string"),
        stub(sent), REGISTRY, 9, "ANSWER {question}", "JUDGE {question} {standard_answer} {model_answer}", tries=1, pause=0.0,
    )
    knowledge = {r.source_file: r for r in out["knowledge"].collect()}
    assert set(knowledge) == {"a.txt", "b.txt", "c.txt", "d.txt"}
    assert sorted(knowledge["b.txt"].key_concepts) == [f"w{i}" for i in range(7)]
    assert len(knowledge["b.txt"].main_findings) > 1 and knowledge["b.txt"].text_content is None
    assert knowledge["a.txt"].text_content == "short w1"

    pairs = out["pairs"].collect()
    by_source = {}
    for r in pairs:
        by_source.setdefault(r.source_file, set()).add(r.question.split()[0])
    every = {"factual", "comparison", "reasoning", "open_ended"}
    assert by_source["a.txt"] == every and by_source["d.txt"] == every and len(by_source["b.txt"]) == 1 and by_source["c.txt"] == {"reasoning"}
    assert {r.question_type for r in pairs if r.question.startswith("factual")} == {"factual"}
    assert {r.question_type for r in pairs if r.question.startswith("reasoning")} == {"given"}

    report = out["report"].first()
    bad = out["verified"].filter(F.col("question").startswith("reasoning"))
    assert {r.quality_label for r in bad.collect()} == {-1}
    assert report.total_qa_pairs == len(pairs) and report.passed_qa_pairs == len(pairs) - bad.count()
    chunks = sum(1 if len(t) <= 2000 else len(knowledge["b.txt"].main_findings) for n, t in docs if t.strip())
    assert sent.value == chunks + len(pairs) + 2 * len(pairs)


def test_final_set_and_stage_counts(spark):
    sent = spark.sparkContext.accumulator(0)

    def factory():
        ask = stub(sent)()

        def client(prompt):
            if prompt.startswith("REWRITE"):
                return '{"question": "better %s", "answer": "b"}' % prompt[8:15] if "factual" in prompt else "no json"
            if prompt.startswith("KNOW broken"):
                return "not json"
            if prompt.startswith("KNOW down"):
                raise ConnectionError("down")
            return ask(prompt)

        return client

    docs = [("a.txt", "w1"), ("d.txt", "w4"), ("broken.txt", "w1"), ("down.txt", "w2")]
    out = text_to_qa(
        spark.createDataFrame(docs, "source_file string, content string"), factory, REGISTRY, 9, "ANSWER {question}",
        "JUDGE {question} {standard_answer} {model_answer}", rewrite_template="REWRITE {question} {answer}", meta={"run": "r1"}, tries=1, pause=0.0,
    )
    final = out["final"].collect()
    verified = out["verified"].collect()
    assert len(final) == sum(r.quality_label == 1 for r in verified) and {r.run for r in final} == {"r1"}
    assert {r.question.startswith("better") for r in final if r.question_type == "factual"} == {True}
    assert not any(r.question.startswith("better") for r in final if r.question_type != "factual")
    stages = {r.stage: (r.rows_in, r.failed, r.rejected, r.rows_out) for r in out["stages"].collect()}
    assert stages["knowledge"] == (4, 1, 1, 2)
    assert stages["judgement"] == (len(verified), 0, len(verified) - len(final), len(final))
    assert stages["rewriting"][0] == len(final) and stages["rewriting"][2] == sum(r.question_type != "factual" for r in final)
    assert out["summary"].first().total_qa_pairs == len(verified)
