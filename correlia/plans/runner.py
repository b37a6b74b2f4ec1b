"""Steps of a pipeline as a graph: a step runs only if its inputs, parameters or code have changed."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Step:
    """run(inputs, output) reads the outputs of the steps it needs and writes its own folder or file."""

    name: str
    run: Callable[[dict[str, str], str], None]
    needs: list[str] = field(default_factory=list)
    params: dict = field(default_factory=dict)
    version: str = "1"


def fingerprint(path: str) -> str:
    """Hash of a file, or of the names and contents of a folder's files (markers and hidden files aside)."""
    h = hashlib.sha256()
    files = [path] if os.path.isfile(path) else sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith(("_", ".")))
    for f in files:
        h.update(os.path.relpath(f, path).encode())
        with open(f, "rb") as x:
            while chunk := x.read(1 << 20):
                h.update(chunk)
    return h.hexdigest()[:16]


def ordered(steps: list[Step]) -> list[Step]:
    """Steps after what they need; an unknown or circular need is an error."""
    by = {s.name: s for s in steps}
    out: list[Step] = []
    state: dict[str, int] = {}

    def visit(name: str) -> None:
        if name not in by:
            raise ValueError(f"unknown step {name}")
        if state.get(name) == 1:
            raise ValueError(f"{name} needs itself")
        if not state.get(name):
            state[name] = 1
            for n in by[name].needs:
                visit(n)
            state[name] = 2
            out.append(by[name])

    for s in steps:
        visit(s.name)
    return out


def run_steps(steps: list[Step], folder: str) -> dict[str, str]:
    """`hecho` or `igual` for every step; the manifest in the folder says what each was made from."""
    manifest_path = os.path.join(folder, "manifest.json")
    manifest = json.load(open(manifest_path)) if os.path.exists(manifest_path) else {}
    done, prints = {}, {}
    for s in ordered(steps):
        output = os.path.join(folder, s.name)
        key = hashlib.sha256(json.dumps([s.version, s.params, {n: prints[n] for n in s.needs}], sort_keys=True).encode()).hexdigest()
        old = manifest.get(s.name, {})
        if old.get("key") == key and os.path.exists(output) and old.get("output") == fingerprint(output):
            done[s.name] = "igual"
        else:
            s.run({n: os.path.join(folder, n) for n in s.needs}, output)
            done[s.name] = "hecho"
        prints[s.name] = fingerprint(output)
        manifest[s.name] = {"key": key, "output": prints[s.name], "params": s.params, "version": s.version}
        tmp = manifest_path + ".tmp"
        with open(tmp, "w") as f:
            json.dump(manifest, f, sort_keys=True, indent=1)
        os.replace(tmp, manifest_path)
    return done


def grid(choices: dict[str, list]) -> list[dict]:
    """All combinations of the given settings, in order."""
    out: list[dict] = [{}]
    for k, values in choices.items():
        out = [{**g, k: v} for g in out for v in values]
    return out
