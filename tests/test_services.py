"""Paced fetching and model calls against counting fakes that write down each request."""

import os
import time
import uuid

from quillgraph.operators import contracts
from quillgraph.sources import answers, fetching


def log_of(folder):
    return [open(f"{folder}/{n}").read() for n in sorted(os.listdir(folder))]


def fake(folder, answer):
    """A service whose requests are files, so tasks in any process are counted; a closure, so it goes to workers by value."""
    folder = str(folder)
    os.makedirs(folder, exist_ok=True)

    def call(asked):
        with open(f"{folder}/{time.time():.6f}-{uuid.uuid4().hex}", "w") as out:
            out.write(asked)
        nth = [open(f"{folder}/{n}").read() for n in os.listdir(folder)].count(asked)
        return answer(asked, nth)

    return call


def urls(spark, hosts, n):
    return spark.createDataFrame([(f"https://h{h}.org/{i:02d}",) for h in range(hosts) for i in range(n)] + [("https://h0.org/00",), (None,)], "url string")


def test_a_stop_ends_all_tasks_without_a_retry(spark, tmp_path):
    service = fake(tmp_path / "log", lambda url, _: (429, "") if url == "https://h1.org/03" else (200, url))
    found = fetching.fetch_paced(urls(spark, 4, 40), service, delay=0.02)
    rows = {r.url: (r.status, r.outcome) for r in found.collect()}
    assert len(rows) == 160 and rows["https://h1.org/03"] == (429, "stopped")
    asked = log_of(tmp_path / "log")
    assert len(asked) == len(set(asked))  # nothing twice, also not by the actions below
    behind = asked[asked.index("https://h1.org/03") + 1 :]
    assert all(sum(u.startswith(f"https://h{h}.org") for u in behind) <= 1 for h in range(4))
    assert rows["https://h1.org/39"] == (None, "stopped") and found.filter("outcome = 'ok'").count() == len(asked) - 1
    assert log_of(tmp_path / "log") == asked


def test_pace_retries_and_answers_that_stay(spark, tmp_path):
    def answer(url, nth):
        if url.endswith("/01") and nth < 3:
            raise OSError("no route")
        return (404, "") if url.endswith("/02") else (503, "") if url.endswith("/03") else (200, "<p>" + url)

    service, folder = fake(tmp_path / "log", answer), f"file://{tmp_path}/answers"
    rows = {r.url[-2:]: (r.status, r.html, r.error, r.outcome) for r in fetching.fetch_paced(urls(spark, 1, 5), service, folder, delay=0.05, backoff=0.01).collect()}
    assert rows["01"] == (200, "<p>https://h0.org/01", None, "ok") and rows["02"] == (404, None, "HTTP 404", "fetch-error") and rows["03"] == (503, None, "HTTP 503", "fetch-error")
    times = sorted(float(n.split("-")[0]) for n in os.listdir(tmp_path / "log"))
    assert min(b - a for a, b in zip(times, times[1:])) > 0.045
    assert sorted(u[-2:] for u in log_of(tmp_path / "log")) == ["00", "01", "01", "01", "02", "03", "03", "03", "04"]
    fetching.fetch_paced(urls(spark, 1, 5), service, folder, delay=0.0, backoff=0.0).collect()
    assert [u[-2:] for u in log_of(tmp_path / "log")[9:]] == ["03", "03", "03"]  # only what had no answer


def test_prompts_are_asked_once_and_failures_are_rows(spark, tmp_path):
    def answer(prompt, nth):
        if prompt == "busy" and nth < 3:
            raise answers.ServiceError(429, retry_after=0.01)
        if prompt == "refused":
            raise answers.ServiceError(401, "no key")
        if prompt == "down":
            raise answers.ServiceError(503)
        return prompt.upper()

    service, folder = fake(tmp_path / "log", answer), f"file://{tmp_path}/answers"
    prompts = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "busy"), ("4", "refused"), ("5", "down"), ("6", None)], "key string, prompt string")
    asked = contracts.ask(prompts, service, folder, delay=0.01)
    rows = {r.key: (r.response, r.failure) for r in asked.collect()}
    assert rows == {"1": ("A", None), "2": ("A", None), "3": ("BUSY", None), "4": (None, "ServiceError: no key"), "5": (None, "ServiceError: HTTP 503"), "6": (None, "no prompt")}
    assert asked.count() == 6 and sorted(log_of(tmp_path / "log")) == ["a", "busy", "busy", "busy", "down", "down", "down", "refused"]
    contracts.ask(prompts.filter("key < '4'"), service, folder).collect()
    assert len(log_of(tmp_path / "log")) == 8
    errors = {r.key: r.error for r in contracts.review(asked).collect()}
    assert errors["4"] == "ServiceError: no key" and errors["1"] == "not the expected JSON"


def test_waiting_as_asked():
    waits, calls = [], iter([answers.ServiceError(429, retry_after=7.0), OSError("x"), answers.ServiceError(500), None])

    def call():
        problem = next(calls)
        if problem:
            raise problem
        return "done"

    assert answers.retried(call, 4, 1.0, waits.append) == "done" and waits == [7.0, 2.0, 4.0]
