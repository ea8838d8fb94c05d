"""The job surface: a registry of page functions, model slots and their configuration."""

from __future__ import annotations

import dataclasses
import warnings
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

Job = Callable[[DataFrame, Any], DataFrame]
_JOBS: dict[str, tuple[Job, type]] = {}


def register(name: str, config: type) -> Callable[[Job], Job]:
    """Names a job; its configuration is a dataclass."""

    def add(f: Job) -> Job:
        _JOBS[name] = (f, config)
        return f

    return add


def find(name: str) -> tuple[Job, type]:
    """The job of that name, else the first registered whose name begins the given one."""
    if name in _JOBS:
        return _JOBS[name]
    for known, job in _JOBS.items():
        if name.startswith(known):
            return job
    raise KeyError(f"no job {name!r}; there are: {', '.join(_JOBS)}")


def configured(kind: type, values: dict[str, Any]) -> Any:
    """Unknown keys are left out with a warning."""
    known = {f.name for f in dataclasses.fields(kind)}
    if extra := sorted(set(values) - known):
        warnings.warn(f"ignored: {', '.join(extra)}", stacklevel=2)
    return kind(**{k: v for k, v in values.items() if k in known})


def run(name: str, pages: DataFrame, config: dict[str, Any] | None = None) -> DataFrame:
    f, kind = find(name)
    return f(pages, configured(kind, config or {}))


def model_slot(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Runs a model over batches of pages. ``load`` makes it once per Python worker; a page that fails becomes an error row and the rest go on.

    The model takes and returns frames; its columns are those of ``schema`` but for error_stage and error_message, which are added.
    """
    names = [p.split()[0] for p in schema.split(",")]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            try:
                out = model(frame)
                out["error_stage"], out["error_message"] = None, None
            except Exception:
                rows = []
                for k in range(len(frame)):
                    one = frame.iloc[k : k + 1]
                    try:
                        rows.append(model(one).assign(error_stage=None, error_message=None))
                    except Exception as e:
                        shared = {c: one[c].to_numpy() if c in one else [None] for c in names}
                        rows.append(pd.DataFrame(shared).assign(error_stage="Model", error_message=f"{type(e).__name__}: {e}"[:512]))
                out = pd.concat(rows)
            yield out[[*names, "error_stage", "error_message"]]

    return df.mapInPandas(work, f"{schema}, error_stage string, error_message string")


def staged(df: DataFrame, stages: list[tuple[str, Callable[[], Callable[[dict], dict]]]], schema: str) -> DataFrame:
    """Rows through the stages of a pipeline, one after the other in one task. Each stage is a function of a row's values, made once a worker, that adds or replaces some.

    An error is a value, not an end: the row keeps what it has of the columns of ``schema`` that came in, the rest is null, and its error_stage, error_type and error_message are
    set; later stages pass it on. Columns of ``schema`` are put out, then the envelope."""
    names = [p.split()[0] for p in schema.split(",")]
    given = set(df.columns)
    envelope = ("error_stage", "error_type", "error_message")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [(name, load()) for name, load in stages]
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                start, error = dict(row), (None, None, None)
                for name, f in made:
                    try:
                        row.update(f(row))
                    except Exception as e:
                        row, error = start, (name, type(e).__name__, str(e)[:512])
                        break
                out.append([*(row.get(c) if error[0] is None or c in given else None for c in names), *error])
            yield pd.DataFrame(out, columns=[*names, *envelope], dtype=object)

    return df.mapInPandas(work, f"{schema}, error_stage string, error_type string, error_message string")


def _within(name: str, value: float, low: float | None = None, high: float | None = None) -> None:
    if low is not None and value < low or high is not None and value > high:
        raise ValueError(f"{name} must be from {low} to {high}, not {value}")


@dataclasses.dataclass(frozen=True)
class JobConfig:
    """What all jobs on pages share."""

    batch_size: int = 64
    concurrency: int = 16
    max_page_failure_rate: float = 0.05
    volume_timeout_s: float = 1800.0
    treat_truncation_as_failure: bool = False
    compression: str = "zstd"

    def __post_init__(self):
        _within("batch_size", self.batch_size, 1)
        _within("concurrency", self.concurrency, 1)
        _within("max_page_failure_rate", self.max_page_failure_rate, 0, 1)


@dataclasses.dataclass(frozen=True)
class LineDetectionConfig(JobConfig):
    batch_size: int = 16
    concurrency: int = 128
    volume_timeout_s: float = 300.0
    max_tiles: int = 80
    class_threshold: float = 0.85
    max_angle_deg: float = 5.0
    min_angle_deg: float = 0.3
    skip_second_pass_deg: float = 3.0
    slice_width: int = 40
    add_corners: bool = True


@dataclasses.dataclass(frozen=True)
class LineTextConfig(JobConfig):
    batch_size: int = 16
    concurrency: int = 64
    volume_timeout_s: float = 3600.0
    beam_width: int = 64
    token_min_logp: float = -3.0
    vocab_prune_threshold: float = -10.0
    greedy_confidence: float = -0.5
    merge_lines: bool = True
    line_threshold: float | None = None


@dataclasses.dataclass(frozen=True)
class PageTextConfig(JobConfig):
    """A model that reads whole pages; its budgets are checked before it is loaded."""

    batch_size: int = 128
    concurrency: int = 32
    memory_share: float = 0.9
    parallel: int = 1
    max_model_len: int = 8192
    max_tokens: int = 3072
    temperature: float = 0.0
    repetition_penalty: float = 1.0
    frequency_penalty: float = 0.0
    presence_penalty: float = 0.0
    max_image_side: int = 2800
    max_image_pixels: int = 4_000_000
    chunk_max_bytes: int = 1_000_000_000

    def __post_init__(self):
        super().__post_init__()
        _within("memory_share", self.memory_share, 0.05, 0.98)
        _within("parallel", self.parallel, 1)
        _within("max_model_len", self.max_model_len, 1024)
        _within("max_tokens", self.max_tokens, 64, self.max_model_len)
        if self.repetition_penalty <= 0:
            raise ValueError("repetition_penalty must be above 0")
        _within("frequency_penalty", self.frequency_penalty, -2, 2)
        _within("presence_penalty", self.presence_penalty, -2, 2)
        _within("max_image_side", self.max_image_side, 256)
        _within("max_image_pixels", self.max_image_pixels, 256 * 256)
        _within("chunk_max_bytes", self.chunk_max_bytes, 0)


@dataclasses.dataclass(frozen=True)
class PageClassConfig(JobConfig):
    labels: tuple[str, ...] = ()
    crop_size: int = 448


@dataclasses.dataclass(frozen=True)
class LayoutConfig(JobConfig):
    classes: tuple[str, ...] = ("header", "text-area", "footnote", "footer")
    min_confidence: float = 0.25


@dataclasses.dataclass(frozen=True)
class LayoutTextConfig(JobConfig):
    """A model that reads pages or regions of them. The second version of the job differs by the three flags of the layout alone."""

    batch_size: int = 128
    volume_timeout_s: float = 3600.0
    max_new_tokens: int = 2048
    scales: tuple[float, ...] = (0.6, 0.75, 1.0)
    least_glyph: float = 24.0
    penalty: float = 0.8
    penalty_base: float = 1.75
    penalty_allowed: int = 12
    penalty_window: int = 512
    penalty_most: int = 50
    retry_temperature: float = 0.4
    retry_n: int = 3
    retry_min_fires: int = 100
    retry_min_score: float = 0.5
    skip_labels: tuple[str, ...] = ("blank", "other-script", "no-plain-text")
    skip_min_prob: float = 0.3
    skip_required: bool = False
    layout_mask: bool = False
    layout_split: bool = False
    layout_footnotes: bool = False
    mask_labels: tuple[str, ...] = ("header", "footer")
    protect_labels: tuple[str, ...] = ("text-area", "footnote")
    mask_pad: int = 2
    least_vertical: float = 0.6
    most_horizontal: float = 0.05
    join: str = "\n\n"


@dataclasses.dataclass(frozen=True)
class CloudTextConfig(JobConfig):
    batch_size: int = 500
    volume_timeout_s: float = 10_800.0
    in_flight: int = 8
    poll_s: float = 30.0
    submit_retries: int = 5
    quota_pause_s: float = 60.0
    quota_factor: float = 1.5
    quota_most_s: float = 900.0
    artifact_suffix: str = "-cloud"


def register_pages(name: str, config: type, kind: str, model: Callable[[Any], Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]] | None = None, **defaults) -> None:
    """Names a job that runs a model over pages and gives artifacts of a kind (``sources.sinks.SCHEMAS``). ``model`` makes, from the configuration, what loads the model in a
    worker; a job without one is a slot: running it is an error that says so. ``defaults`` replace those of the configuration."""
    from ..sources.sinks import SCHEMAS, conformed

    bare = ", ".join(p for p in _columns(SCHEMAS[kind]) if p.split()[0] not in ("ok", "error_stage", "error_type", "error_message"))

    def run_pages(pages: DataFrame, settings) -> DataFrame:
        if model is None:
            raise NotImplementedError(f"{name} needs a model: register_pages({name!r}, ..., model=...)")
        return conformed(model_slot(pages, model(settings), bare), kind)

    _JOBS[name] = (run_pages, config if not defaults else dataclasses.make_dataclass(f"{config.__name__}_{name}", [(k, type(v), v) for k, v in defaults.items()], bases=(config,), frozen=True))


def _columns(schema: str) -> list[str]:
    """The columns of a DDL text: commas within brackets don't part them."""
    out, depth = [""], 0
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [c.strip() for c in out]


for _name, _config, _kind, _flags in (
    ("line_detection", LineDetectionConfig, "line_detection", {}), ("line_text", LineTextConfig, "line_text", {}), ("page_text", PageTextConfig, "page_text", {}), ("page_class_v2", PageClassConfig, "page_class", {}),
    ("page_class", PageClassConfig, "page_class", {}), ("layout", LayoutConfig, "page_class", {}), ("layout_text_v2", LayoutTextConfig, "page_text_layout", {"layout_mask": True, "layout_split": True, "layout_footnotes": True}),
    ("layout_text", LayoutTextConfig, "page_text_layout", {}), ("cloud_text", CloudTextConfig, "cloud_text", {}),
):
    register_pages(_name, _config, _kind, **_flags)


@dataclasses.dataclass(frozen=True)
class Sweep:
    """How a page is read in an evaluation: the samplings to run, (temperature, samples, scores of the five likeliest tokens wanted) each."""

    name: str
    samplings: tuple[tuple[float, int, bool], ...]

    def runs(self, config: PageTextConfig) -> list[dict[str, Any]]:
        shared = {"max_tokens": config.max_tokens, "repetition_penalty": config.repetition_penalty, "frequency_penalty": config.frequency_penalty, "presence_penalty": config.presence_penalty}
        return [shared | {"temperature": t, "n": n} | ({"logprobs": 5} if scored else {}) for t, n, scored in self.samplings]


SWEEPS = {s.name: s for s in (Sweep("minimal", ((0.0, 1, False),)), Sweep("entropy", ((0.0, 1, True),)), Sweep("consistency", ((0.5, 2, False),)), Sweep("full", ((0.0, 1, True), (1.0, 1, False))))}


class RepeatGuard:
    """Lowers, for one request, the scores of tokens that would go on with a repeat; keeps how often and how hard it struck, in ``stats``."""

    def __init__(self, config: LayoutTextConfig | None = None, breakers: frozenset = frozenset()):
        self.config, self.breakers, self.stats = config or LayoutTextConfig(), breakers, {"fires": 0, "max_length": 0, "max_penalty": 0.0, "sum_penalty": 0.0, "first_pos": None, "last_pos": None}

    def __call__(self, ids: list[int], scores):
        from ..functions.sequences import match_lengths

        c = self.config
        hits = {t: n for t, n in match_lengths(ids, c.penalty_window, c.penalty_most, self.breakers).items() if n >= c.penalty_allowed} if c.penalty > 0 else {}
        for t, n in hits.items():
            scores[t] -= c.penalty * c.penalty_base ** (n - c.penalty_allowed)
        if hits:
            top, s = max(hits.values()), self.stats
            worst = c.penalty * c.penalty_base ** (top - c.penalty_allowed)
            s |= {"fires": s["fires"] + 1, "max_length": max(s["max_length"], top), "max_penalty": max(s["max_penalty"], worst), "sum_penalty": s["sum_penalty"] + worst, "first_pos": s["first_pos"] or len(ids), "last_pos": len(ids)}
        return scores


@dataclasses.dataclass(frozen=True)
class CountConfig:
    least: int = 1


@register("count_words", CountConfig)
def count_words(pages: DataFrame, config: CountConfig) -> DataFrame:
    """A stand-in model: counts the words of a page."""
    least = config.least

    def load():
        return lambda f: pd.DataFrame({"page_id": f["page_id"], "n": [max(least, len(t.split())) for t in f["page_text"]]})

    return model_slot(pages.select("page_id", "page_text"), load, "page_id long, n long")
