"""Settings of a run on the driver: a YAML file merged over defaults, and paths relative to a root."""

from __future__ import annotations

from pathlib import Path

from plinth.operators.classify import Options

# What holds where the file says nothing.
DEFAULTS = {
    "chemistry_normalization": {"enabled": True, "unicode_subscript": False},
    "figures": {"include_material_state_photos": True, "include_schematics_for_vision": False, "include_spinnability_photos_for_vision": True},
    "service": {"poll_interval_seconds": 3, "max_wait_seconds": 600, "save_raw": True, "save_cleaned": True},
}


def load_settings(path: str | Path) -> dict:
    """An empty file gives the defaults; a missing one is an error."""
    import yaml

    given = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    out = {name: {**values, **(given.get(name) or {})} for name, values in DEFAULTS.items()}
    return {**given, **out}


def resolved(path: str | Path, root: str | Path) -> Path:
    return Path(path) if Path(path).is_absolute() else Path(root) / path


def figure_options(settings: dict) -> Options:
    return Options(**{k: bool(v) for k, v in settings["figures"].items() if k in DEFAULTS["figures"]})
