"""File trees as tables, fingerprints of trees, and the sinks: JSON lines, immutable folders, one pointer."""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import re
import shutil
import subprocess
import tempfile
import urllib.request
from collections.abc import Iterator
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json, digest

SOURCE_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
PROVIDERS = ("auto", "local", "http", "git")
MAX_BYTES, CHUNK = 100 << 20, 1 << 20
ENTRY_SCHEMA = "path string, kind string, size long, sha256 string, executable boolean, target string"
TREE_HEADER = "kst-tree-v2\n"


def source_id_valid(source_id: Column) -> Column:
    return F.coalesce(source_id.rlike(SOURCE_ID), F.lit(False))


def infer_provider(locator: Column) -> Column:
    """git, http or local from the shape of a locator."""
    path = F.regexp_replace(locator, "[?#].*$", "")
    return (
        F.when(locator.startswith("git+"), "git")
        .when(locator.rlike(r"^[^/@:\s]+@[^/:\s]+:"), "git")
        .when(locator.rlike("(?i)^https?://"), F.when(path.endswith(".git"), "git").otherwise("http"))
        .when(locator.rlike("(?i)^file:"), "local")
        .when(locator.rlike("(?i)^(git|ssh)://"), "git")
        .otherwise("local")
    )


def safe_path(path: Column) -> Column:
    """Relative, without empty, '.' or '..' parts."""
    return F.coalesce(~path.rlike(r"^$|^/|\\|(^|/)(\.{0,2})(/|$)"), F.lit(False))


def validate_spec(source_id: str, locator: str, provider: str = "auto", ref: str | None = None) -> str:
    """The provider of a request that is in order; raises KStateError otherwise."""
    if not re.match(SOURCE_ID, source_id or ""):
        raise KStateError(f"unsafe source id {source_id!r}")
    if not (locator or "").strip():
        raise KStateError("empty locator")
    if provider not in PROVIDERS:
        raise KStateError(f"unknown provider {provider!r}")
    if ref is not None and provider not in ("auto", "git"):
        raise KStateError("a ref belongs to git sources")
    if provider != "auto":
        return provider
    if locator.startswith("git+") or re.match(r"^[^/@:\s]+@[^/:\s]+:", locator):
        return "git"
    parts = urlsplit(locator)
    if parts.scheme.lower() in ("http", "https"):
        return "git" if parts.path.endswith(".git") else "http"
    return "git" if parts.scheme.lower() in ("git", "ssh") else "local"


# -- acquisition (control plane) ------------------------------------------------------------------


def local_path(locator: str) -> Path:
    """The path a plain or file: locator names; other hosts are refused."""
    if locator.lower().startswith("file:"):
        parts = urlsplit(locator)
        if parts.netloc not in ("", "localhost"):
            raise KStateError("file locator names another host")
        locator = unquote(parts.path)
    return Path(locator).expanduser()


def fetch_http(url: str, to: Path, max_bytes: int = MAX_BYTES, timeout: float = 30) -> dict:
    """One GET in chunks; credentials in the URL, other schemes after a redirect and longer bodies are refused."""
    if max_bytes <= 0:
        raise KStateError("the size limit must be positive")
    parts = urlsplit(url)
    if parts.scheme.lower() not in ("http", "https"):
        raise KStateError(f"{parts.scheme!r} is no http scheme")
    if parts.username or parts.password:
        raise KStateError("credentials in a URL are refused")
    done = 0
    with urllib.request.urlopen(url, timeout=timeout) as got, to.open("wb") as out:  # noqa: S310
        if urlsplit(got.geturl()).scheme not in ("http", "https"):
            raise KStateError("redirect leaves http")
        while block := got.read(CHUNK):
            done += len(block)
            if done > max_bytes:
                raise KStateError(f"body exceeds {max_bytes} bytes")
            out.write(block)
        head = got.headers
        return {"final_url": got.geturl(), "status": got.status, "content_type": head.get("Content-Type"), "content_length": done, "etag": head.get("ETag"), "last_modified": head.get("Last-Modified")}


def git(*args: str, cwd: str | Path | None = None, timeout: float = 300) -> bytes:
    env = os.environ | {"GIT_TERMINAL_PROMPT": "0", "GIT_ALLOW_PROTOCOL": "file:git:http:https:ssh"}
    done = subprocess.run(["git", *args], cwd=cwd, env=env, capture_output=True, timeout=timeout, check=False)
    if done.returncode:
        raise KStateError(f"git {args[0]} failed: {done.stderr.decode('utf-8', 'replace').strip()[:300]}")
    return done.stdout


def acquire(source_id: str, locator: str, root: Path, provider: str = "auto", ref: str | None = None, replace: bool = False, max_bytes: int = MAX_BYTES) -> dict:
    """Brings a source under ``root/source_id`` with a receipt; an earlier one stays unless ``replace``, and on failure."""
    kind = validate_spec(source_id, locator, provider, ref)
    root = Path(root)
    root.mkdir(parents=True, exist_ok=True)
    final = root / source_id
    if final.exists() and not replace:
        raise KStateError(f"{source_id} was acquired before")
    work = Path(tempfile.mkdtemp(prefix=".acquire-", dir=root))
    try:
        artifact, seen = work / "artifact", {}
        if kind == "git":
            where = locator.removeprefix("git+")
            if where.startswith("ext::"):
                raise KStateError("external git transports are refused")
            git("clone", "--bare", "--quiet", "--", where, str(artifact))
            if ref:
                seen["commit"] = git("rev-parse", "--verify", "--quiet", "--end-of-options", f"{ref}^{{commit}}", cwd=artifact).decode().strip()
        elif kind == "http":
            seen = fetch_http(locator, artifact, max_bytes)
        else:
            src = local_path(locator)
            # the artifact keeps the name of its source
            seen = {"source_name": src.name or "source"}
            artifact = work / "payload" / seen["source_name"]
            artifact.parent.mkdir()
            if src.is_dir() and not src.is_symlink():
                if root.resolve().is_relative_to(src.resolve()):
                    raise KStateError("the output lies inside the source")
                shutil.copytree(src, artifact, symlinks=True)
            elif src.is_symlink() or src.is_file():
                shutil.copy2(src, artifact, follow_symlinks=False)
            else:
                raise KStateError(f"no file, folder or link at {locator}")
        shape = "git" if kind == "git" else "symlink" if artifact.is_symlink() else "directory" if artifact.is_dir() else "file"
        receipt = {"schema_version": 1, "stage": "acquire", "source_id": source_id, "provider": kind, "locator": locator, "acquired_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "artifact": {"path": artifact.relative_to(work).as_posix(), "kind": shape}, "observations": seen}
        if ref:
            receipt["requested_ref"] = ref
        write_manifest(work / "receipt.json", receipt)
        swap_in(work, final)
        return receipt
    finally:
        shutil.rmtree(work, ignore_errors=True)


def swap_in(work: Path, final: Path) -> None:
    """Puts a finished folder in its place; an older one comes back if that fails."""
    old = None
    if final.exists():
        old = final.with_name(f".old-{final.name}-{os.getpid()}")
        final.rename(old)
    try:
        work.rename(final)
    except OSError:
        if old:
            old.rename(final)
        raise
    if old:
        shutil.rmtree(old, ignore_errors=True)


# -- trees ----------------------------------------------------------------------------------------


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content, size) of every file under a folder, paths relative to it; a distributed scan."""
    base = os.path.abspath(root).rstrip("/")
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    rel = F.regexp_replace(F.expr("url_decode(regexp_replace(path, '\\\\+', '%2B'))"), "^file:/*" + re.escape(base) + "/?", "")
    return d.select(rel.alias("path"), "content", F.col("length").alias("size"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Entries of a tree: kind, size, hash, executable bit, link target; '.' for the root. Devices and sockets are refused.

    The driver lists names; the workers read and hash the files, so the root has to be a folder all nodes share.
    """
    rows = []

    def walk(p: Path, rel: str) -> None:
        if p.is_symlink():
            rows.append((rel, "symlink", None, os.readlink(p)))
        elif p.is_dir():
            rows.append((rel, "directory", None, None))
            for child in sorted(os.scandir(p), key=lambda e: os.fsencode(e.name)):
                walk(Path(child.path), child.name if rel == "." else f"{rel}/{child.name}")
        elif p.is_file():
            rows.append((rel, "file", bool(p.stat().st_mode & 0o111), None))
        else:
            raise KStateError(f"{rel} is no file, folder or link")

    def read(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        for b in batches:
            out = []
            for rel, kind, executable, target in b.itertuples(index=False):
                size = sha = None
                if kind == "file":
                    place = Path(root) if rel == "." else Path(root) / rel
                    size = place.stat().st_size
                    with place.open("rb") as f:
                        sha = hashlib.file_digest(f, "sha256").hexdigest()
                out.append((rel, kind, size, sha, executable, target))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in ENTRY_SCHEMA.split(", ")]).astype({"size": "Int64", "executable": "boolean"})

    walk(Path(root), ".")
    listed = spark.createDataFrame(rows, "path string, kind string, executable boolean, target string")
    return listed.mapInPandas(read, ENTRY_SCHEMA)


def depth_first(path: Column) -> Column:
    """Sort key of a depth-first walk: a folder's content comes before what merely starts with its name."""
    return F.split(path, "/")


def entry_line(path: Column, kind: Column, size: Column, sha256: Column, executable: Column, target: Column) -> Column:
    """One entry as a line; fields are length-prefixed, so no name can imitate another entry."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.concat_ws(" ", *(part(c) for c in (path, kind, size, sha256, executable, target)))


def tree_fingerprint(entries: DataFrame, by: list[str]) -> DataFrame:
    """(by..., entries, fingerprint): SHA-256 over the entries in a fixed order; times and owners do not count.

    Lines are hashed first, gathered in up to 4,096 parts a tree by the hash of their path, and the parts' hashes give
    the tree's, so no task holds more than a part.
    """
    e = entries.withColumn("line", F.sha2(entry_line(*(F.col(c) for c in ("path", "kind", "size", "sha256", "executable", "target"))), 256))
    e = e.withColumn("part", F.sha2("path", 256).substr(1, 3))
    p = e.groupBy(*by, "part").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256).alias("h"))
    g = p.groupBy(*by).agg(F.sum("n").alias("entries"), F.array_sort(F.collect_list(F.struct("part", "h"))).alias("all"))
    return g.select(*by, "entries", F.sha2(F.concat(F.lit(TREE_HEADER), F.array_join(F.transform("all", lambda x: x["h"]), "\n")), 256).alias("fingerprint"))


def git_lock(repo: str | Path, ref: str | None = None) -> dict:
    """What a bare repository's ref (or HEAD) selects."""
    if git("rev-parse", "--is-bare-repository", cwd=repo).strip() != b"true":
        raise KStateError("repository is not bare")
    name = ref or "HEAD"
    ask = lambda *a: git(*a, cwd=repo).decode().strip()
    obj = ask("rev-parse", "--verify", "--end-of-options", name)
    return {"object": obj, "object_type": ask("cat-file", "-t", obj), "commit": ask("rev-parse", "--verify", "--end-of-options", f"{name}^{{commit}}"), "object_format": ask("rev-parse", "--show-object-format"), "ref": name}


def snapshot_id(lock: dict | None, fingerprint: str | None) -> str:
    """Identity of a snapshot: of a git lock without its label, else of the tree."""
    return digest({k: v for k, v in lock.items() if k != "ref"}) if lock else f"sha256-{fingerprint}"


def tree_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Entries that only one of two trees has, with a side; repeated entries count."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


# -- JSON and publication -------------------------------------------------------------------------


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of canonical JSON lines, of one file or a folder of parts; a line that is no object of the schema's types fails the read.

    Every file has to end in a line feed: the last bytes are looked at where the files are read.
    """

    def last(batches):  # noqa: ANN001, ANN202
        for b in batches:
            yield b[[_ends_badly(p) for p in b["path"]]]

    files_ = sorted(str(p) for p in Path(path).glob("part-*")) if Path(path).is_dir() else [path]
    bad = spark.createDataFrame([(p,) for p in files_], "path string").mapInPandas(last, "path string").limit(1).collect() if files_ else []
    if bad:
        raise KStateError(f"{bad[0].path} does not end in a line feed")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def _ends_badly(path: str) -> bool:
    with open(path, "rb") as f:
        f.seek(0, os.SEEK_END)
        if not f.tell():
            return False
        f.seek(-1, os.SEEK_END)
        return f.read(1) != b"\n"


def write_json_lines(df: DataFrame, path: str, order: list[str], parts: bool = False) -> None:
    """Canonical JSON lines in the given order: ordered by range and written part by part, as a folder or joined to one file.

    With ``parts`` the result is a folder whose files, taken by name, are in order, and no byte passes through the driver.
    """
    names = df.columns
    work = Path(path) if parts else Path(path).with_name(f".{Path(path).name}-{os.getpid()}")

    def lines(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"value": [canonical_json({n: _plain(v) for n, v in zip(names, row)}) for row in b.itertuples(index=False)]})

    text = df.orderBy(*order).mapInPandas(lines, "value string")
    if parts:
        text.write.text(str(work))
        return
    try:
        text.write.text(str(work))
        with open(path, "wb") as out:
            for part in sorted(work.glob("part-*")):
                with part.open("rb") as f:
                    shutil.copyfileobj(f, out)
    finally:
        shutil.rmtree(work, ignore_errors=True)


def _plain(v):  # noqa: ANN001, ANN202
    import numpy as np

    if isinstance(v, np.ndarray | list | tuple):
        return [_plain(x) for x in v]
    if isinstance(v, np.generic):
        v = v.item()
    return None if isinstance(v, float) and v != v else v


def read_manifest(path: str | Path) -> dict:
    try:
        value = json.loads(Path(path).read_text("utf-8"))
    except (OSError, ValueError) as e:
        raise KStateError(f"{path} cannot be read: {e}") from e
    if not isinstance(value, dict):
        raise KStateError(f"{path} holds no object")
    return value


def write_manifest(path: str | Path, value: dict) -> None:
    Path(path).write_text(json.dumps(value, indent=2, sort_keys=True) + "\n", "utf-8")


def publish(folder: Path, files: dict[str, bytes]) -> bool:
    """Puts files under a content-addressed folder once. True if new, False if equal files were there; else an error."""
    folder = Path(folder)
    if folder.exists():
        there = {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}
        if there == files:
            return False
        raise KStateError(f"{folder} holds other files: {sorted(set(there) ^ set(files)) or 'same names'}")
    folder.parent.mkdir(parents=True, exist_ok=True)
    work = Path(tempfile.mkdtemp(prefix=".publish-", dir=folder.parent))
    try:
        for name, data in files.items():
            (work / name).parent.mkdir(parents=True, exist_ok=True)
            (work / name).write_bytes(data)
        try:
            work.rename(folder)
        except OSError:
            return publish(folder, files) if folder.exists() else (_ for _ in ()).throw(KStateError(f"cannot publish {folder}"))
        return True
    finally:
        shutil.rmtree(work, ignore_errors=True)


def write_pointer(path: Path, value: dict) -> None:
    """Replaces the pointer file at one stroke."""
    path = Path(path)
    fd, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(fd, "w") as f:
        f.write(json.dumps(value, indent=2, sort_keys=True) + "\n")
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)


@contextlib.contextmanager
def exclusive(path: Path) -> Iterator[None]:
    """One writer at a time."""
    with open(path, "a") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)
