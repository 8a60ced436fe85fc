"""Dataset schemas: components, cameras, tick rate and action spaces, declared in YAML files.

A schema's widths are always the sums of its components' widths; nothing is
inferred from data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame

from tickloom.operators.actions import positions, width

SCHEMAS = Path(__file__).parent / "schemas"
REQUIRED = ("dataset_source", "ingestion_strategy", "tick_fps", "camera_keys", "state_components", "action_components")


@dataclass(frozen=True)
class RobotSchema:
    dataset_source: str
    ingestion_strategy: str
    tick_fps: float
    camera_keys: tuple[str, ...]
    state_components: tuple[tuple[str, int], ...]
    action_components: tuple[tuple[str, int], ...]
    depth_camera_keys: tuple[str, ...] = ()
    action_spaces: dict[str, tuple[str, ...]] = field(default_factory=dict)
    options: dict = field(default_factory=dict)

    @property
    def state_dim(self) -> int:
        return width(self.state_components)

    @property
    def action_dim(self) -> int:
        return width(self.action_components)

    @property
    def step_ns(self) -> int:
        return int(1e9 / self.tick_fps)

    @property
    def camera_topics(self) -> dict[str, tuple[str, ...]]:
        """Camera -> topics that may carry it, by the mcap block: top_topics, wrist_camera_topics; others '/<camera>'."""
        declared = self.options.get("mcap") or {}
        named = {"top": declared.get("top_topics"), **(declared.get("wrist_camera_topics") or {})}
        found = {c: named.get(c) or f"/{c}" for c in self.camera_keys}
        return {c: (t,) if isinstance(t, str) else tuple(t) for c, t in found.items()}

    def select_action_space(self, space: str | None) -> RobotSchema:
        """The schema with the actions of one space and those that belong to no space; None changes nothing."""
        if space is None:
            return self
        if space not in self.action_spaces:
            raise ValueError(f"{self.dataset_source} has the action spaces {sorted(self.action_spaces)}, not {space!r}")
        others = {c for name, members in self.action_spaces.items() for c in members if name != space} - set(self.action_spaces[space])
        kept = tuple(c for c in self.action_components if c[0] not in others)
        return RobotSchema(**{**self.__dict__, "action_components": kept})

    def action_positions(self, selected: RobotSchema) -> list[int]:
        return positions(self.action_components, selected.action_components)


def available_sources(folder: Path = SCHEMAS) -> list[str]:
    return sorted(p.stem for p in Path(folder).glob("*.yaml"))


def build_schema(spec: dict, name: str = "schema") -> RobotSchema:
    missing = [k for k in REQUIRED if k not in spec]
    if missing:
        raise ValueError(f"{name}: missing {', '.join(missing)}")
    pairs = lambda key: tuple((str(n), int(d)) for n, d in spec[key])
    known = {*REQUIRED, "depth_camera_keys", "action_spaces"}
    return RobotSchema(
        spec["dataset_source"], spec["ingestion_strategy"], float(spec["tick_fps"]), tuple(spec["camera_keys"]), pairs("state_components"), pairs("action_components"),
        tuple(spec.get("depth_camera_keys", ())), {k: tuple(v) for k, v in (spec.get("action_spaces") or {}).items()}, {k: v for k, v in spec.items() if k not in known},
    )


def load_schema(source: str, folder: Path = SCHEMAS) -> RobotSchema:
    """The schema of a source; the file's name and its dataset_source must agree."""
    import yaml

    path = Path(folder) / f"{source}.yaml"
    if not path.exists():
        raise ValueError(f"unknown dataset source {source!r}, one of {available_sources(folder)}")
    spec = yaml.safe_load(path.read_text())
    if spec.get("dataset_source") != source:
        raise ValueError(f"{path.name} declares {spec.get('dataset_source')!r}")
    return build_schema(spec, source)


def schemas_of(table: DataFrame) -> dict[str, RobotSchema]:
    """Schemas from a robot_schemas table. One small row a source."""
    out = {}
    for row in table.collect():
        parts = lambda c, row=row: tuple((x["name"], x["dim"]) for x in row[c])
        out[row.dataset_source] = RobotSchema(row.dataset_source, row.ingestion_strategy, row.tick_fps, tuple(row.camera_keys), parts("state_components"), parts("action_components"))
    return out


def conversion_params(schema: RobotSchema, tasks: list[str], cap: int, image_size: tuple[int, int], revision: str | None = None) -> dict:
    """The fingerprint of a request. Tasks are sorted: their order changes nothing."""
    return {
        "dataset_source": schema.dataset_source, "tasks": sorted(tasks), "max_episodes_per_task": cap, "tick_fps": schema.tick_fps, "image_size": list(image_size),
        "camera_keys": list(schema.camera_keys), "depth_camera_keys": list(schema.depth_camera_keys), "revision": revision,
    }
