"""Readers of sequence, annotation, ontology, hit and embedding files."""

from annofold.sources.annotations import (
    hit_table,
    labels_tsv,
    string_table,
    taxon_list_tsv,
    taxonomy_tsv,
    typed_table,
)
from annofold.sources.fasta import fasta, parsed_header
from annofold.sources.manifests import manifest_csv, shard_list, shard_vectors
from annofold.sources.obo import obo
from annofold.sources.raw_files import copy_required_files, raw_file_report, raw_file_summary

__all__ = [
    "copy_required_files",
    "fasta",
    "hit_table",
    "labels_tsv",
    "manifest_csv",
    "obo",
    "parsed_header",
    "raw_file_report",
    "raw_file_summary",
    "shard_list",
    "shard_vectors",
    "string_table",
    "taxon_list_tsv",
    "taxonomy_tsv",
    "typed_table",
]
