"""Batched scoring with a model of the caller's. The only place where Python runs on rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.functions import batch_prompt, chat_messages, first_nonempty, image_list
from framelark.schemas import BATCH_PROMPT, BATCH_SIZE, RESULT

Generate = Callable[[list[dict[str, Any]]], list[str]]


def scoring_input(
    pending: DataFrame, default_prompt: str = BATCH_PROMPT, system_prompt: str | Column | None = None
) -> DataFrame:
    """Inference manifest records with defaults filled in and chat messages assembled."""
    system = F.lit(system_prompt) if isinstance(system_prompt, str) else system_prompt
    filled = pending.select(
        "id",
        first_nonempty("prompt", F.lit(default_prompt)).alias("prompt"),
        image_list("images", "image").alias("images"),
    )
    return filled.withColumn("messages", chat_messages(batch_prompt(F.size("images"), "prompt"), system))


def score(
    records: DataFrame,
    model_factory: Callable[[], Generate],
    load_image: Callable[[str], Any],
    model_name: str,
    batch_size: int = BATCH_SIZE,
    max_images: int | None = None,
    partitions: int | None = None,
    spread_by: str | Column = "id",
    keep_model_as: str | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Score records in batches; every record yields one result row of its own.

    ``model_factory`` runs in the task, once, and only if the task has a record to score. ``load_image`` failing for
    a record gives that record an error and leaves the rest of its batch alone; the model failing gives each record
    of the batch an error. A model that cannot be made fails the task. Batches are refilled over Arrow batch borders,
    so only a task's last one is short. An image that several records of a batch share is loaded once. ``partitions``
    spreads the records by the hash of ``spread_by``. ``keep_model_as`` names the model in its Python worker, so that later tasks of
    a reused worker find it loaded, if it is of the same factory; use more partitions than workers then, to even out slow
    ones. ``carry`` names columns of the records that go into the results as they are.
    """
    from pyspark import cloudpickle

    carry = carry or []
    columns = ["id", "prompt", "images", "output", "model", "error", *carry]
    kept_as = keep_model_as and (keep_model_as, hashlib.sha256(cloudpickle.dumps(model_factory)).hexdigest())

    def run(frames):
        import sys

        import pandas as pd

        kept = sys.__dict__.setdefault("_scoring_models", {})
        generate = kept.get(kept_as)
        held: list[dict[str, Any]] = []

        def results(batch):
            nonlocal generate
            rows, ready, images = [], [], {}
            for rec in batch:
                refs = [str(r) for r in rec["images"]]
                try:
                    if max_images is not None and len(refs) > max_images:
                        raise ValueError(f"{len(refs)} images, at most {max_images} allowed")
                    for r in refs:
                        if r not in images:
                            images[r] = load_image(r)
                except Exception as e:
                    rows.append((rec["id"], rec["prompt"], None, None, None, f"image_load: {e}", *(rec[c] for c in carry)))
                else:
                    messages = [{"role": m["role"], "content": m["content"]} for m in rec["messages"]]
                    ready.append((rec, refs, {"prompt": rec["prompt"], "messages": messages, "images": [images[r] for r in refs]}))
            if ready and generate is None:
                generate = model_factory()
                if keep_model_as is not None:
                    kept[kept_as] = generate
            if ready:
                try:
                    answers = list(generate([item for _, _, item in ready]))
                    if len(answers) != len(ready):
                        raise ValueError(f"{len(answers)} answers for {len(ready)} records")
                    answers = [answer.strip() for answer in answers]
                except Exception as e:
                    rows += [(rec["id"], None, None, None, None, f"generate: {e}", *(rec[c] for c in carry)) for rec, _, _ in ready]
                else:
                    rows += [
                        (rec["id"], rec["prompt"], refs, answer, model_name, None, *(rec[c] for c in carry))
                        for (rec, refs, _), answer in zip(ready, answers)
                    ]
            return pd.DataFrame(rows, columns=columns)

        for frame in frames:
            held += frame.to_dict("records")
            while len(held) >= batch_size:
                yield results(held[:batch_size])
                held = held[batch_size:]
        if held:
            yield results(held)

    spread = records.repartition(partitions, spread_by) if partitions else records
    schema = T.StructType([*T.StructType.fromDDL(RESULT).fields, *(records.schema[c] for c in carry)])
    return spread.select("id", "prompt", "images", "messages", *carry).mapInPandas(run, schema)
