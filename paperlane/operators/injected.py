"""L1-L3: injected document functions run per partition on Arrow batches.

A service (translator, model, extractor) enters a job only as a function
over a pandas batch. It runs inside ``mapInPandas`` / a pandas UDF: one
client per partition, Arrow transfer, a retry policy with back-off, and every
failure turned into an ``error`` value on its row, so a bad row never fails
a stage (Spark's own task retry still covers lost executors).
"""
from __future__ import annotations

import random
import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class CallPolicy:
    """L2: attempts, exponential back-off with cap and jitter, retried exceptions."""
    max_attempts: int = 3
    base_delay: float = 1.0
    backoff: float = 2.0
    max_delay: float = 30.0
    jitter: float = 0.2
    retry_on: tuple = (Exception,)

    def waits(self) -> list[float]:
        """Seconds to wait before each further attempt: ``base_delay`` times a
        power of ``backoff``, up to ``jitter`` more, never above ``max_delay``."""
        steps = (min(self.base_delay * self.backoff ** k, self.max_delay) for k in range(self.max_attempts - 1))
        return [min(s * (1 + self.jitter * random.random()), self.max_delay) for s in steps]

    def call(self, fn: Callable, *args):
        """Returns ``(result, error, attempts)``; never raises."""
        if self.max_attempts < 1:
            return None, "no attempt made", 0
        error = None
        for made, wait in enumerate([0.0, *self.waits()], start=1):
            time.sleep(wait)
            try:
                return fn(*args), None, made
            except Exception as exc:  # noqa: BLE001 - every failure becomes a value
                error = f"{type(exc).__name__}: {exc}"
                if not isinstance(exc, self.retry_on):
                    break
        return None, error, made


NO_WAIT = CallPolicy(base_delay=0.0)


def apply_document_fn(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], in_cols: list[str],
                      out_schema: T.StructType, keep_cols: list[str] | None = None,
                      policy: CallPolicy = CallPolicy(), make_client: Callable | None = None) -> DataFrame:
    """L1: run ``fn(batch[in_cols]) -> DataFrame[out_schema fields]`` on every
    Arrow batch of every partition.

    ``make_client`` (optional) is called once per partition and passed as the
    second argument of ``fn``. A batch that fails is retried row by row so one
    bad row costs only its own result; output adds ``error`` and ``attempts``.
    """
    keep = list(keep_cols or [])
    fields = [df.schema[c] for c in keep] + list(out_schema.fields) + [
        T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())]
    schema = T.StructType(fields)
    out_names = [f.name for f in out_schema.fields]

    def run(batches):
        client = make_client() if make_client else None
        call = (lambda b: fn(b, client)) if make_client else fn
        for batch in batches:
            inp = batch[in_cols]
            res, err, att = policy.call(call, inp)
            if err is None and res is not None and len(res) == len(batch):
                out = pd.DataFrame({n: res[n].values for n in out_names})
                out["error"] = None
                out["attempts"] = att
            else:
                rows = []
                for i in range(len(batch)):
                    r, e, a = policy.call(call, inp.iloc[i:i + 1])
                    vals = {n: (r[n].iloc[0] if e is None and r is not None and len(r) else None) for n in out_names}
                    vals["error"] = e
                    vals["attempts"] = att + a  # those of the whole batch went before
                    rows.append(vals)
                out = pd.DataFrame(rows, columns=out_names + ["error", "attempts"])
            for c in reversed(keep):
                out.insert(0, c, batch[c].values)
            yield out[[f.name for f in fields]]

    return df.select(*dict.fromkeys(keep + in_cols)).mapInPandas(run, schema)


@dataclass(frozen=True)
class Limits:
    """How a partition calls a service: calls ``at_once``, seconds for one
    document (its attempts and waits together; None: no limit), and after how
    many failures in a row the partition's other documents are not sent any
    more (None: never). ``ahead`` results wait at most for an earlier one."""
    at_once: int = 5
    deadline: float | None = 600.0
    stop_after: int | None = None
    ahead: int = 20


class _Call:
    __slots__ = ("started", "outcome")

    def __init__(self, outcome=None):
        self.started, self.outcome = time.monotonic(), outcome


class _Calls:
    """The calls of one partition. A call that passes its deadline is given up:
    its row gets an error, its thread ends by itself. While ``at_once`` of such
    threads still run, no other call begins."""

    def __init__(self, fn: Callable, policy: CallPolicy, limits: Limits):
        self.fn, self.policy, self.limits = fn, policy, limits
        self.changed, self.running, self.failures, self.late = threading.Condition(), [], 0, 0

    def _start(self, row) -> _Call:
        if self.limits.stop_after is not None and self.failures >= self.limits.stop_after:
            return _Call((None, f"not called: {self.failures} failures in a row", 0))
        made = _Call()
        self.running.append(made)

        def run():
            outcome = self.policy.call(self.fn, row)
            with self.changed:
                if made.outcome is None:
                    made.outcome = outcome
                else:
                    self.late -= 1
                self.changed.notify()

        threading.Thread(target=run, daemon=True).start()
        return made

    def _settle(self) -> None:
        now, limit = time.monotonic(), self.limits.deadline
        for made in list(self.running):
            if made.outcome is None and limit is not None and now - made.started >= limit:
                made.outcome = (None, f"deadline: no result in {limit:g} s", None)
                self.late += 1
            if made.outcome is not None:
                self.running.remove(made)
                self.failures = self.failures + 1 if made.outcome[1] is not None else 0

    def outcomes(self, rows):
        """``(result, error, attempts)`` of each row, in their order."""
        rows, waiting, more = iter(rows), deque(), True
        while True:
            with self.changed:
                self._settle()
                while (more and len(waiting) < self.limits.ahead and len(self.running) < self.limits.at_once
                       and self.late < self.limits.at_once):
                    row = next(rows, None)
                    more = row is not None
                    if more:
                        waiting.append(self._start(row))
                if not waiting and not more:
                    return
                if not waiting or waiting[0].outcome is None:
                    ends = [c.started + self.limits.deadline - time.monotonic() for c in self.running
                            if self.limits.deadline is not None]
                    self.changed.wait(max(0.0, min(ends)) if ends else None)
                    continue
                ready = waiting.popleft().outcome
            yield ready


def apply_concurrently(df: DataFrame, fn: Callable[[dict], dict], in_cols: list[str], out_schema: T.StructType,
                       keep_cols: list[str] | None = None, policy: CallPolicy = CallPolicy(),
                       limits: Limits = Limits(), make_client: Callable | None = None, chunk: int = 200) -> DataFrame:
    """L1 and L2 for services that take one document a call: ``fn(row)`` gets
    the ``in_cols`` of a row and returns the fields of ``out_schema``; several
    calls of a partition run at once (they wait for a service, so threads do),
    rows come out in their order, ``chunk`` at a time, with ``error`` and
    ``attempts`` (null after a deadline). No failure fails the stage. A result
    that lacks a field has null there.
    """
    keep, names = list(keep_cols or []), [f.name for f in out_schema.fields]
    schema = T.StructType([df.schema[c] for c in keep] + list(out_schema.fields) + [
        T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())])

    def run(batches):
        client = make_client() if make_client else None
        calls = _Calls((lambda r: fn(r, client)) if make_client else fn, policy, limits)
        for batch in batches:
            for begin in range(0, len(batch), chunk):
                some = batch.iloc[begin:begin + chunk]
                inputs = [dict(zip(in_cols, values, strict=True)) for values in some[in_cols].itertuples(index=False)]
                out = {c: some[c].to_numpy() for c in keep}
                made = list(calls.outcomes(inputs))
                for n in names:
                    out[n] = pd.Series([(r or {}).get(n) for r, _, _ in made], dtype=object)
                out["error"] = pd.Series([e for _, e, _ in made], dtype=object)
                out["attempts"] = pd.Series([a for _, _, a in made], dtype=object)
                yield pd.DataFrame(out, columns=schema.names)

    return df.select(*dict.fromkeys(keep + in_cols)).mapInPandas(run, schema)


def structured_output_schema(json_schema: dict) -> T.DataType:
    """L3: JSON-schema (function-call ``parameters``) -> Spark type for
    ``from_json``. In a list of types ``null`` adds nothing (every field may be
    null); several others become text."""
    t = json_schema.get("type")
    if isinstance(t, list):
        named = [x for x in t if x != "null"]
        t = named[0] if len(named) == 1 else "string"
    if t == "object":
        props = json_schema.get("properties", {})
        return T.StructType([T.StructField(k, structured_output_schema(v), True) for k, v in props.items()])
    if t == "array":
        return T.ArrayType(structured_output_schema(json_schema.get("items", {"type": "string"})))
    return {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(),
            "boolean": T.BooleanType()}.get(t, T.StringType())


def schema_violations(record: Column, json_schema: dict, at: str = "") -> list[Column]:
    """L3: what a typed record breaks of its schema: ``missing:<path>`` for a
    required field that is null and ``enum:<path>`` for a value outside the
    field's list; one column each, null where all is well. Objects are followed;
    of an array the first violation of its items is told."""
    out = []
    for name, rule in json_schema.get("properties", {}).items():
        value, path = record[name], f"{at}{name}"
        if name in json_schema.get("required", ()):
            out.append(F.when(value.isNull(), F.lit(f"missing:{path}")))
        if "enum" in rule:
            listed = [x for x in rule["enum"] if x is not None]
            out.append(F.when(~value.isin(*listed), F.lit(f"enum:{path}")))
        if rule.get("type") == "object":
            out += [F.when(value.isNotNull(), c) for c in schema_violations(value, rule, f"{path}.")]
        if rule.get("type") == "array" and rule.get("items", {}).get("type") == "object":
            out.append(F.get(F.flatten(F.transform(value, _item_check(rule["items"], f"{path}."))), F.lit(0)))
    return out


def _item_check(schema: dict, at: str):
    """The violations of one array item, as an array."""
    return lambda item: F.filter(F.array(*schema_violations(item, schema, at), F.lit(None).cast("string")),
                                 lambda x: x.isNotNull())
