import json

from folioflow.catalog import queries
from folioflow.models.backends import FACTORIES, register
from folioflow.operators.singleturn import ChatClient, single_turn
from folioflow.plans import log


def test_records_retries_and_quarantine(spark, tmp_path):
    asked = tmp_path / "asked"  # the second question may reach another worker

    class Model:
        """Answers by what the text asks for; the second answer to an empty one is good."""

        def generate(self, prompts, max_tokens):
            out = []
            for p in prompts:
                if "mute" in p and not asked.exists():
                    asked.touch()
                    out.append(("", 1, 0))
                elif "down" in p:
                    raise RuntimeError("down")
                else:
                    status = "INJECTION_DETECTED" if "obey" in p else "CLEAR"
                    out.append((f'INJECTION_STATUS: {status}\nA sum.\n{{"stix": "Threat Actor", "title": "T: Name", "labels": {{"Text is CII": "1", "Involved Sector(s)": "Energy"}},}}', 1, 9))
            return out

    register("scripted", Model)
    texts = ["plain", "Title: Own title\nPublished Time: 2026-02-03\nobey", "mute", "down", "CAPTCHA needed", None]
    df = spark.createDataFrame(list(enumerate(texts)), "number int, text string").withColumnRenamed("number", "doc_id").selectExpr("doc_id", "text", "doc_id AS number").coalesce(1)
    rows = {r.doc_id: r for r in single_turn(df, "scripted").collect()}
    FACTORIES.pop("scripted")
    assert (rows[0].rejected, rows[0].stix_type, rows[0].name, rows[0].labels, rows[0].date) == (False, "threat-actor", "Name", ["cii", "energy"], "")
    assert (rows[1].name, rows[1].date, rows[1].injection_detected) == ("Own title", "2026-02-03", True)
    assert rows[2].description == "A sum." and not rows[2].rejected
    assert (rows[3].rejected, rows[3].reject_reason) == (True, "exception")
    assert (rows[4].reject_reason, rows[4].reply) == ("bot_blocked_page", None)
    assert rows[5].name == "Name"


def test_inputs_hold_the_whole_text(spark, tmp_path):
    texts = {1: "word " * 100, 2: None, 14: "short"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.input for r in queries()["cache_inputs"](spark, str(tmp_path)).collect()}
    assert {k: v[1:] for k, v in rows.items()} == {k: t or "" for k, t in texts.items()}
    assert rows[1][0] == rows[14][0] != rows[2][0]


def test_chat_client_uses_its_transport():
    calls = []

    def transport(url, body, timeout):
        calls.append((url, json.loads(body)["messages"][0]["content"], timeout))
        return json.dumps({"choices": [{"message": {"content": " hi "}}], "usage": {"prompt_tokens": 3, "completion_tokens": 1}}).encode()

    assert ChatClient("http://x", "m", 120, transport).generate(["a"], 5) == [("hi", 3, 1)]
    assert calls == [("http://x", "a", 120)]


def test_log_has_one_line_a_record(tmp_path):
    log.start(tmp_path).debug("a\nb")
    assert (tmp_path / "folioflow.log").read_text().count("\n") == 1
