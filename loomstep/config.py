"""Configuration documents on the driver: arguments, overrides, defaults of older documents, and contracts.

Documents are nested dictionaries. Nothing here touches data; what it settles is handed to the operators as plain arguments.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

# The document version that :func:`upgraded` leaves, and the paths that it fills.
VERSION = "0.21"
ACTION, DIFFUSION, LANGUAGE = ("framework", "action_model"), ("framework", "action_model", "diffusion_model_cfg"), ("framework", "qwenvl")


def dotlist(args: Sequence[str]) -> list[str]:
    """Command-line arguments as key=value entries: ``--a.b v``, ``--a.b=v`` and, for true, ``--flag``. Words that belong to no
    option are passed over."""
    out, waiting = [], None
    for arg in [*args, "--"]:
        if not arg.startswith("--"):
            if waiting is not None:
                out.append(f"{waiting}={arg}")
            waiting = None
            continue
        if waiting is not None:
            out.append(f"{waiting}=true")
        name = arg.lstrip("-")
        if "=" in name:
            out.append(name)
        waiting = name if name and "=" not in name else None
    return out


def scalar(text: str) -> Any:
    """A value as a document would have it: true, false, null, a number, a JSON list or object, or the text itself."""
    plain = {"true": True, "false": False, "null": None, "~": None, "": None}
    if text.lower() in plain:
        return plain[text.lower()]
    try:
        return json.loads(text)
    except ValueError:
        return text


def get(document: Mapping, path: Sequence[str], default: Any = None) -> Any:
    for name in path:
        if not isinstance(document, Mapping) or name not in document:
            return default
        document = document[name]
    return document


def put(document: dict, path: Sequence[str], value: Any) -> None:
    for name in path[:-1]:
        if not isinstance(document.get(name), dict):
            document[name] = {}
        document = document[name]
    document[path[-1]] = value


def overridden(document: Mapping, overrides: Sequence[str] | None = None) -> dict:
    """The document with key=value entries put in, later ones over earlier ones. The document itself stays as it is, and what
    no entry names, interpolations included, is carried over untouched."""
    if isinstance(overrides, str):
        raise TypeError("overrides must be a sequence of KEY=VALUE strings, not one string")
    if wrong := [x for x in overrides or () if not isinstance(x, str)]:
        raise TypeError(f"overrides must be a sequence of KEY=VALUE strings; got {wrong}")
    if wrong := [x for x in overrides or () if "=" not in x or not x.split("=", 1)[0].strip(".")]:
        raise ValueError(f"Expected KEY=VALUE, got {wrong}")
    out = copy.deepcopy(dict(document))
    for entry in overrides or ():
        key, value = entry.split("=", 1)
        put(out, key.split("."), scalar(value))
    return out


def upgraded(document: Mapping | None, strict: bool = False, warn=print) -> dict | None:
    """An older document as one of this version: the horizon and the window behind it follow from each other (the horizon
    counts where they disagree, or, with ``strict``, that is an error), and sizes that were left out are taken from the ones
    that they always equalled."""
    if document is None:
        return None
    out = copy.deepcopy(dict(document))
    model = get(out, ACTION)
    if model is not None:
        horizon, window = model.get("action_horizon"), model.get("future_action_window_size")
        if horizon is None and window is not None:
            horizon = model["action_horizon"] = int(window) + 1
        if horizon is not None:
            if window is not None and int(window) != int(horizon) - 1:
                text = f"action_horizon={horizon} and future_action_window_size={window} disagree"
                if strict:
                    raise ValueError(text)
                warn(f"{text}; the horizon counts")
            model["future_action_window_size"] = int(horizon) - 1
        hidden = model.get("hidden_size")
        diffusion = get(out, DIFFUSION)
        if diffusion is not None:
            for name, source in (("output_dim", hidden), ("cross_attention_dim", get(out, (*LANGUAGE, "vl_hidden_dim")))):
                if diffusion.get(name) is None and source is not None:
                    diffusion[name] = int(source)
        if model.get("action_hidden_dim") is None and hidden is not None:
            model["action_hidden_dim"] = int(hidden)
        if model.get("past_action_window_size") is None:
            model["past_action_window_size"] = 0
    out["version_id"] = VERSION
    return out


def leaf_paths(paths: Iterable[str]) -> set[str]:
    """Those of the paths (a.b[0].c) that none of the others goes on from. One look per path and prefix, not per pair."""
    found, inner = set(paths), set()
    for path in found:
        inner.update(path[:k] for k, c in enumerate(path) if c in ".[" and k)
    return found - inner


def modality_keys(configs: Mapping[str, Mapping]) -> dict[str, list[str]]:
    """Keys of each modality, from configurations {modality: {"keys": [...], "offsets": [...]}}."""
    return {modality: list(c["keys"]) for modality, c in configs.items()}


def key_offsets(configs: Mapping[str, Mapping]) -> dict[str, list[int]]:
    """Offsets of each key: those of its modality."""
    return {key: list(c["offsets"]) for c in configs.values() for key in c["keys"]}


@dataclass(frozen=True)
class SamplePolicy:
    """How samples are fitted and which are turned away."""

    action_horizon: int
    action_dim: int
    state_dim: int | None = None
    strict_dimensions: bool = True
    max_views: int | None = None
    max_abs_action: float | None = None
    reject_static_actions: bool = False
    static_action_epsilon: float = 1e-6
    retry_bad_samples: int = 20

    @classmethod
    def of(cls, data: Mapping, model: Mapping | None = None) -> SamplePolicy:
        """Dimensions may come from the data's section or the model's; both must agree where both say something."""

        def size(name: str, needed: bool) -> int | None:
            said = [int(x[name]) for x in (data, model or {}) if x.get(name) is not None]
            if len(set(said)) > 1:
                raise ValueError(f"{name} mismatch: data has {said[0]}, the action model {said[1]}")
            if not said and needed:
                raise ValueError(f"{name} is needed in the data's or the action model's section")
            return said[0] if said else None

        off = str(data.get("include_state", "")).lower() in ("false", "0")
        rest = {k: data[k] for k in ("strict_dimensions", "max_views", "max_abs_action", "reject_static_actions", "static_action_epsilon", "retry_bad_samples") if data.get(k) is not None}
        return cls(size("action_horizon", True), size("action_dim", True), None if off else size("state_dim", False), **rest)


def check_server(seed: int, metadata: Mapping | None) -> None:
    """An evaluation may only run against a server that says what it serves, with the evaluation's own seed."""
    if not metadata or not metadata.get("ckpt_path"):
        raise ValueError("the server's metadata must name its ckpt_path")
    if metadata.get("seed") is None:
        raise ValueError("the server's metadata must name its seed")
    if metadata["seed"] != seed:
        raise ValueError(f"evaluation seed {seed} does not match the server's seed {metadata['seed']}")


def observation_faults(examples: Sequence[Mapping], expected: tuple[int, int] | None) -> list[str]:
    """What is wrong with a batch of observations ({"image": [(height, width), ...]}): no images, images of another size than
    in training, or unlike numbers of images."""
    out, counts = [], set()
    for k, example in enumerate(examples):
        images = example.get("image")
        if images is None:
            out.append(f"example {k} has no image")
            continue
        counts.add(len(images))
        out += [f"example {k}, image {i}: {tuple(hw)} is not {tuple(expected)}" for i, hw in enumerate(images) if expected and tuple(hw) != tuple(expected)]
    return out + ([f"unlike numbers of images: {sorted(counts)}"] if len(counts) > 1 else [])
