"""Command line: init, list, validate, lint, describe, schema, fetch, preview, render,
publish, clean, audit.  Exit codes: 0 fine, 1 lint, 2 usage, 3 validation, 4 fetch,
5 render, 6 destination or corrupt output, 7 publishing."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
from pathlib import Path

from .plans import recipe as R
from .plans import validate as V


def _session():
    from .session import build

    return build(**{"spark.ui.showConsoleProgress": "false"})


def _load(arg: str) -> R.Recipe:
    return R.load_recipe(R.resolve_recipe(arg))


def _show(found: list) -> None:
    for severity, code, message, at in found:
        print(f"{severity}: {code}: {message}" + (f" ({at})" if at else ""))


def global_log() -> Path:
    """The log of all runs of this user."""
    return Path(os.environ.get("SCRIPTORIUM_AUDIT") or Path.home() / ".local/share/scriptorium/audit.jsonl")


def stamp(raw: str | None) -> str | None:
    """A bound as the log writes times, in UTC; what has no zone is UTC; None if it is no time."""
    try:
        found = dt.datetime.fromisoformat((raw or "").strip())
    except ValueError:
        return None
    found = found.replace(tzinfo=dt.UTC) if found.tzinfo is None else found.astimezone(dt.UTC)
    return found.isoformat().replace("+00:00", "Z")


def _cache(a):
    from .sources.cache import CacheStore

    return None if getattr(a, "no_cache", False) else CacheStore(a.cache)


def _audit(a) -> int:
    from pyspark.errors import PySparkException

    from .operators import audit as A
    from .sources.readers import numbered_lines

    path = Path(a.audit_file or (Path(a.directory) / "_audit.jsonl" if a.directory else global_log()))
    if not path.is_file():
        if not a.directory and not a.audit_file:
            print("no runs")
            return 0
        print(f"{path}: not found", file=sys.stderr)
        return 6
    since, until = stamp(a.since), stamp(a.until)
    if (a.limit is not None and a.limit <= 0) or (a.since and not since) or (a.until and not until):
        print("--limit is above zero; --since and --until are dates or times", file=sys.stderr)
        return 2
    spark = _session()
    try:
        runs, unknown = A.read_log(numbered_lines(spark, str(path)))
        runs = A.select_runs(runs, since, until, a.recipe_sha)
        if a.limit:
            runs = A.tail(runs, a.limit)
        if a.summary:
            print(json.dumps({**A.summary(runs).first().asDict(), "top_shas": [r.asDict() for r in A.top_shas(runs).collect()]}))
        else:
            for row in runs.orderBy("line_no").toLocalIterator():
                print(json.dumps(row.asDict()))
        for row in unknown.collect():  # one row for each version there is
            print(f"left out: {row['n']} rows of version {row['version']}", file=sys.stderr)
    except PySparkException as e:
        print(str(e).split("\n")[0], file=sys.stderr)
        return 6
    return 0


def _render(a) -> int:
    from .plans import run
    from .sources.sinks import DestinationNotEmptyError, SnapshotError

    recipe = _load(a.recipe)
    try:
        if a.dry_run:
            print(json.dumps(run.plan(_session(), recipe, _cache(a))))
            return 0
        quiet = a.no_audit or os.environ.get("SCRIPTORIUM_NO_AUDIT")
        stats = run.render(_session(), recipe, force=a.force, resume=a.resume, cache=_cache(a), audit=None if quiet else [str(global_log())], log=not quiet)
        for failed in stats["audit_failures"]:
            print(f"the audit log couldn't be written: {failed}", file=sys.stderr)
        print(json.dumps(stats))
    except (DestinationNotEmptyError, SnapshotError) as e:
        print(e, file=sys.stderr)
        return 6
    except Exception as e:  # noqa: BLE001 - whatever stops a run is its exit code
        print(e, file=sys.stderr)
        return 5
    return 0


def _publish(a) -> int:
    """Stages the dataset by its mode, and uploads it unless ``--dry-run`` says what would be
    done.  A flag goes before the recipe, the recipe before the default."""
    from .sources import sinks

    recipe = _load(a.recipe)
    ours = recipe.publish or R.Publish()
    staging = Path(a.staging or f"{recipe.output.destination}-staging")
    repo, private = a.repo or ours.repo_id, ours.private if a.private is None else a.private
    try:
        staged = sinks.STAGING[recipe.output.mode](recipe.output.destination, staging, a.license or ours.license, overwrite=True)
    except (sinks.StagingError, OSError) as e:
        print(e, file=sys.stderr)
        return 6
    problems = sinks.preflight(staging) if (staging / "README.md").is_file() else [("README.md", "missing")]
    plan = staged | {"mode": recipe.output.mode, "repo": repo, "private": private, "tag": a.tag, "message": sinks.commit_message(a.message, staging), "files": sum(p.is_file() for p in staging.rglob("*")), "bytes": sum(p.stat().st_size for p in staging.rglob("*") if p.is_file()), "problems": problems}
    print(json.dumps(plan))
    if a.dry_run:
        return 0
    if problems or not repo:
        print(f"nothing is published: {problems or 'no repository is named'}", file=sys.stderr)
        return 7
    try:
        token = sinks.resolve_token(a.token, dict(os.environ), Path.home() / ".cache/huggingface/token")
        print(json.dumps(sinks.publish(sinks.HubTransport(token), repo, staging, private=private, message=a.message, tag=a.tag)))
    except Exception as e:  # noqa: BLE001 - whatever stops an upload is its exit code
        print(e, file=sys.stderr)
        return 7
    return 0


def _fetch(a) -> int:
    from .plans import run

    rows = run.fetch(_session(), _load(a.recipe), _cache(a), a.refresh)
    print("\n".join(json.dumps(r) for r in rows))
    return 4 if any(r["error"] for r in rows) else 0


def _clean(a) -> int:
    from .plans.run import entry_key
    from .sources.cache import CacheStore

    store = CacheStore(a.cache)
    print(sum(store.remove(e["type"], entry_key(e)) for e in _load(a.recipe).model_dump()["corpus"]))
    return 0


def _preview(a) -> int:
    from .plans import run

    try:
        print(json.dumps(run.preview(_session(), _load(a.recipe), a.out, a.count, _cache(a))))
    except Exception as e:  # noqa: BLE001 - whatever stops a run is its exit code
        print(e, file=sys.stderr)
        return 5
    return 0


def _check(a, lint: bool) -> int:
    found = V.issues(_load(a.recipe), lint)
    _show(found)
    if any(x[0] == "error" for x in found):
        return 3
    return 1 if lint and a.strict and found else 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="scriptorium")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *options, recipe: bool = True):
        c = sub.add_parser(name)
        if recipe:
            c.add_argument("recipe")
        for flags, kw in options:
            c.add_argument(*flags, **kw)
        c.set_defaults(run=run)

    yes = {"action": "store_true"}
    cache = (["--cache"], {"default": ".cache/scriptorium"})
    command("init", lambda a: print(R.scaffold_recipe(a.name, a.folder)) or 0, (["name"], {}), (["--folder"], {"default": "recipes"}), recipe=False)
    command("list", lambda a: print("\n".join(f"{n}\t{path}" for n, path in R.list_recipes().items())) or 0, recipe=False)
    command("validate", lambda a: _check(a, False))
    command("lint", lambda a: _check(a, True), (["--strict"], yes))
    command("describe", lambda a: print(_load(a.recipe).model_dump_json(indent=1)) or 0)
    command("schema", lambda a: print(json.dumps(R.json_schema(), indent=1)) or 0, recipe=False)
    command("fetch", _fetch, cache, (["--refresh"], yes))
    uncached = (["--no-cache"], yes)
    command("preview", _preview, cache, uncached, (["--out"], {"default": "preview"}), (["--count"], {"type": int, "default": 50}))
    command("render", _render, cache, uncached, (["--no-audit"], yes), (["--force"], yes), (["--resume"], yes), (["--dry-run"], yes))
    named = [([f"--{n}"], {}) for n in ("staging", "repo", "license", "message", "tag", "token")]
    command("publish", _publish, *named, (["--private"], {"action": argparse.BooleanOptionalAction}), (["--dry-run"], yes))
    command("clean", _clean, cache)
    command("audit", _audit, (["directory"], {"nargs": "?"}), (["--audit-file"], {}), (["--since"], {}), (["--until"], {}), (["--recipe-sha"], {}), (["--limit"], {"type": int}), (["--summary"], yes), recipe=False)
    a = p.parse_args(argv)
    try:
        return a.run(a)
    except R.RecipeError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
