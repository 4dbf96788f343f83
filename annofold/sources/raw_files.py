"""Presence of the raw input files. Ids: SRC-16, SRC-17, SNK-03. Driver-side utilities over a few files."""

from __future__ import annotations

from collections.abc import Sequence

from pyarrow import fs as pa_fs

from annofold.sinks import arrow_store

# The input files of a full run.
REQUIRED_FILES = (
    "train_sequences.fasta",
    "train_terms.tsv",
    "train_taxonomy.tsv",
    "testsuperset.fasta",
    "testsuperset-taxon-list.tsv",
    "go-basic.obo",
    "IA.tsv",
    "sample_submission.tsv",
)


def raw_file_report(folder: str, required: Sequence[str] = REQUIRED_FILES) -> dict[str, object]:
    """Which of the ``required`` files are in ``folder``, and their sizes."""
    store, inner = arrow_store(folder)
    files = []
    for name in required:
        info = store.get_file_info(f"{inner.rstrip('/')}/{name}")
        files.append({"file_name": name, "path": f"{str(folder).rstrip('/')}/{name}", "exists": info.is_file, "size_bytes": info.size if info.is_file else None})
    missing = [f["file_name"] for f in files if not f["exists"]]
    return {
        "raw_dir": str(folder),
        "required_count": len(files),
        "present_count": len(files) - len(missing),
        "missing_count": len(missing),
        "all_present": not missing,
        "present": [f["file_name"] for f in files if f["exists"]],
        "missing": missing,
        "files": files,
    }


def raw_file_summary(report: dict) -> str:
    """The report as lines of text."""
    lines = [f"{report['raw_dir']}: {report['present_count']} of {report['required_count']} files"]
    for f in report["files"]:
        lines.append(f"  {f['file_name']}: " + (f"{f['size_bytes']} bytes" if f["exists"] else "missing"))
    return "\n".join(lines)


def copy_required_files(source: str, folder: str, required: Sequence[str] = REQUIRED_FILES, overwrite: bool = False) -> list[str]:
    """Copy each required file from anywhere under ``source``; the names copied. Existing files stay unless ``overwrite``."""
    (origin, inside), (store, inner) = arrow_store(source), arrow_store(folder)
    store.create_dir(inner, recursive=True)
    listed = origin.get_file_info(pa_fs.FileSelector(inside, recursive=True))
    paths = {f.base_name: f.path for f in sorted(listed, key=lambda f: f.path, reverse=True) if f.is_file}
    copied = []
    for name in required:
        target = f"{inner.rstrip('/')}/{name}"
        if name in paths and (overwrite or store.get_file_info(target).type == pa_fs.FileType.NotFound):
            pa_fs.copy_files(paths[name], target, source_filesystem=origin, destination_filesystem=store)
            copied.append(name)
    return copied
