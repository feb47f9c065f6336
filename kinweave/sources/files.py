"""Archives, JSON files and reports at the edge of a run; all on the driver, none of it data."""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import os
import shutil
import stat
import zipfile
from pathlib import Path


def extract(archive: str, destination: str, marker: str = "train_source1.tsv") -> Path:
    """Unpacks a ZIP and gives the folder above the one that holds ``marker``.

    Members that leave the destination, and links, are refused; a member of the
    right size isn't unpacked again; the archive may take at most nine tenths of
    the free disk, and must hold the marker once.
    """
    root = Path(destination).resolve()
    root.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive) as z:
        members = z.infolist()
        for m in members:
            if not (root / m.filename).resolve().is_relative_to(root):
                raise ValueError(f"{m.filename} leaves the destination")
            if stat.S_ISLNK(m.external_attr >> 16):
                raise ValueError(f"{m.filename} is a link")
        left = [m for m in members if not m.is_dir() and not ((p := root / m.filename).is_file() and p.stat().st_size == m.file_size)]
        if sum(m.file_size for m in left) > 0.9 * shutil.disk_usage(root).free:
            raise OSError("not enough free disk for the archive")
        for m in left:
            z.extract(m, root)
    found = list(root.rglob(marker))
    if len(found) != 1:
        raise ValueError(f"{marker} stands {len(found)} times in the archive")
    return found[0].parent.parent


def write_json(path: str, value) -> None:
    """Writes beside the file first, so that readers see the old or the new one."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    draft = target.with_name(target.name + ".draft")
    draft.write_text(json.dumps(value, indent=2, ensure_ascii=False, default=str), encoding="utf-8")
    os.replace(draft, target)


def put_text(spark, path: str, text: str) -> None:
    """Writes a small text file where Spark's own files are; readers see the old or the new one."""
    jvm = spark._jvm
    target, draft = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.draft"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(draft, target)


def get_text(spark, path: str) -> str | None:
    """The text of such a file, or None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def code_fingerprint() -> str:
    """Of the versions and the code that results depend on."""
    root = Path(__file__).resolve().parent.parent
    own = [p for p in sorted(root.rglob("*.py")) if p.relative_to(root).parts[0] in ("sources", "functions", "operators")]
    versions = {name: importlib.metadata.version(name) for name in ("pyspark", "numpy", "pyarrow", "pandas")}
    return fingerprint(versions, [hashlib.sha256(p.read_bytes()).hexdigest() for p in own])


def fingerprint(*parts) -> str:
    """Sixteen hexadecimal digits that change with any of the values."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]


def pack(path: str, files: dict[str, str], required: tuple[str, ...] = ()) -> list[str]:
    """A ZIP of the files (name in the archive: place) that exist; a required one that is missing, or has an open TODO, is an error."""
    for name in required:
        if not Path(files[name]).is_file():
            raise FileNotFoundError(files[name])
        if "TODO" in Path(files[name]).read_text(encoding="utf-8"):
            raise ValueError(f"{name} has an open TODO")
    kept = sorted(n for n, p in files.items() if Path(p).is_file())
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for n in kept:
            z.write(files[n], n)
    return kept
