"""Planners: pure functions of a few numbers, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Least GB of memory, batch size, most workers, chunk MB.
CAPACITY = [(32, 10000, 12, 500), (16, 7500, 8, 250), (8, 5000, 6, 100), (0, 2000, 4, 50)]
# GPUs, batch of each, accumulation, steps a second (of each GPU for the last).
GPU = {1: (4, 4, 2.5), 2: (4, 4, 5.0), 4: (6, 4, 2.0)}


def _tier(value: Column, at: int) -> Column:
    return reduce(lambda c, t: c.when(value >= t[0], t[at]), CAPACITY[1:-1], F.when(value >= CAPACITY[0][0], CAPACITY[0][at])).otherwise(CAPACITY[-1][at])


def capacity(memory_gb: Column, cores: Column, disk_gb: Column) -> dict[str, Column]:
    return {
        "recommended_batch_size": _tier(memory_gb, 1), "recommended_workers": F.least(cores, _tier(memory_gb, 2)), "chunk_size_mb": _tier(memory_gb, 3),
        "disk_warning": disk_gb < 200, "estimated_max_dataset_gb": F.least(F.lit(150.0), disk_gb * 0.7), "parallel_source_processing": cores >= 6,
    }


def cleaning(records: Column) -> dict[str, Column]:
    workers = F.when(records > 1_000_000, F.greatest(F.lit(2), F.least(F.lit(8), F.floor(records / 100_000)))).when(records > 500_000, 4).otherwise(2)
    return {"batch_size": F.when(records > 1_000_000, 5000).when(records > 500_000, 3000).otherwise(2000), "n_workers": workers}


def processing(records: Column, gb: Column, workers: Column) -> dict[str, Column]:
    """Plan over all sources: staged above ten million records."""
    return {"staged": records > 10_000_000, "hours": records / (2000 * workers), "disk_gb": gb * 3}


def _rounded(steps: Column) -> Column:
    every = F.greatest(F.lit(100), F.floor(steps / 20))
    return F.floor(steps / every) * every


def training(tokens: Column, gpus: int) -> dict[str, Column]:
    """Steps for 2.5 epochs, rounded to checkpoint intervals; three GPUs take the two-GPU batch."""
    batch, accumulate, rate = GPU[1 if gpus == 1 else 2 if gpus < 4 else 4]
    rate *= gpus if gpus >= 4 else 1
    effective = batch * accumulate * gpus
    per_step = effective * 1024
    steps = _rounded(F.floor(F.floor(tokens / per_step) * 2.5))
    return {
        "effective_batch_size": F.lit(effective), "tokens_per_step": F.lit(per_step), "recommended_steps": steps, "save_steps": F.greatest(F.lit(100), F.floor(steps / 15)),
        "logging_steps": F.greatest(F.lit(10), F.floor(steps / 100)), "hours": F.round(steps / rate / 3600, 6), "data_utilization": F.round(steps * per_step / tokens, 6),
    }


def local_training(tokens: Column) -> dict[str, Column]:
    """Two GPUs; epochs by the number of tokens; at most 50,000 steps."""
    epochs = F.when(tokens > 10_000_000_000, 0.5).when(tokens > 1_000_000_000, 1.0).otherwise(2.5)
    steps = F.least(F.floor(F.floor(tokens / 32768) * epochs), F.lit(50_000))
    done = _rounded(steps)
    return {"target_epochs": epochs, "recommended_steps": done, "save_steps": F.greatest(F.lit(100), F.floor(done / 15)), "logging_steps": F.greatest(F.lit(10), F.floor(done / 100)), "hours": F.round(done / 5.0 / 3600, 6)}


def parameters(vocab: Column, hidden: Column, positions: Column, inner: Column, layers: Column) -> Column:
    layer = 4 * hidden * hidden + 2 * hidden * inner + 4 * hidden
    return 2 * vocab * hidden + positions * hidden + layers * layer


def low_rank_parameters(rank: Column, inputs: Column, outputs: Column) -> Column:
    return rank * (inputs + outputs)


def ready(data_files: Column, scripts: Column, memory_gb: Column, disk_gb: Column) -> Column:
    return (data_files > 0) & (scripts > 0) & (memory_gb >= 4) & (disk_gb >= 20)


def unified_estimates(gigabytes: Column, rows: Column) -> dict[str, Column]:
    """Hours of extraction and processing and the cleaned size, by fixed rates: half an hour a GB, 50,000 rows an hour, 30 % left."""
    extraction, processing = F.greatest(F.lit(1.0), gigabytes * 0.5), F.greatest(F.lit(2.0), rows / 50_000)
    return {"extraction_hours": extraction, "processing_hours": processing, "total_hours": extraction + processing, "clean_gb": gigabytes * 0.3}


def run_arithmetic(steps: Column, batch: int, accumulation: int, gpus: int, length: int, save_steps: int, corpus: int = 51_000_000_000, rate: float = 20.0) -> dict[str, Column]:
    """Tokens, epochs, hours and checkpoints of a training run over a corpus of ``corpus`` tokens at ``rate`` steps a second."""
    per_step = batch * accumulation * gpus * length
    return {
        "effective_batch": F.lit(batch * accumulation * gpus), "tokens_per_step": F.lit(per_step).cast("long"), "total_tokens": (steps * per_step).cast("long"),
        "epochs": steps * per_step / F.lit(float(corpus)), "hours": steps / F.lit(rate) / 3600, "checkpoints": F.floor(steps / save_steps),
    }
