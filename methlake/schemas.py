"""Schemas of the tables the operators exchange. Missing values are NULL, never NaN."""

from __future__ import annotations

CPG = "sample_id string, chrom string, pos long, methyl long, unmethyl long"
CONTIGS = "chrom string, len long"
INTERVALS = "chrom string, start long, stop long"
TSS_BINS = "gene string, chrom string, start long, stop long, offset int"
MANIFEST = "sample_id string, dna_raw_sample string, rna_sample string, species string, protocol string, notes string"
BARCODE_MAP = "DNA_Barcode string, PlateID string, Cell_Order string"
CELL_MANIFEST = "sample_id string, project_sample_id string, species string, protocol string, plate_id string, cell_order string, dna_barcode string, dna_raw_sample string, rna_sample string, notes string"
READ = "lane int, ordinal long, id string, seq string, qual string"
BARCODE_COUNTS = "barcode string, count long, below_q20 array<long>, q30 array<long>"
ALIGNMENT = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
UMI_OBSERVATION = "sample_id string, chrom string, pos long, context string, umi string, state int, qual long, mate string, readpos long, readlen long"
DEMUX_REPORT = (
    "schema_version int, build_version string, source_revision string, mode string, retention_policy string, retention_threshold long, input_fastq_pairs int, input_read_pairs long, "
    "usable_read_pairs long, matched_reads long, read_fates struct<dna_assigned: long, ambiguous: long, unmatched: long, short: long>, "
    "samples array<struct<sample_name: string, cell_sample_id: string, plate_id: string, cell_order: string, dna_barcode: string, dna_read_count: long, dna_status: string>>"
)
#: columns of the per-cell QC table, in order
QC_COLUMNS = (
    "sample_id clone_id plate_id native_mapping_pct unique_cpg_sites cpg_rate_pct lambda_sites lambda_rate_pct puc19_sites puc19_rate_pct non_cpg_pct high_cph_pct "
    "signal_host_pct signal_lambda_pct signal_puc19_pct signal_mt_pct gini duplicate_pct trim_retention_pct final_yield_pct"
).split()
