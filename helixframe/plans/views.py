"""Sequencing tables derived from the generic ones, in SQL that Spark and DuckDB share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_H = "'0123456789abcdef'"

VIEWS = {
    "contigs": "select concat('chr', cast(r_regionkey+1 as string)) chrom, cast(100000+1000*r_regionkey as bigint) length from region",
    "targets": """select concat('chr', cast(o_custkey % 5 + 1 as string)) chrom, cast((o_orderkey*7919) % 99000 as bigint) as start_pos,
        cast((o_orderkey*7919) % 99000 + 20 + o_custkey % 180 as bigint) as end_pos, concat('t', cast(o_orderkey as string)) name
        from orders""",
    "alignments": """select concat('r', cast(l_orderkey as string),'_',cast(l_linenumber as string),'_',cast(l_partkey as string)) qname,
        case when l_linestatus='O' then 'tumor' else 'normal' end sample, concat('chr', cast(l_suppkey % 5 + 1 as string)) chrom,
        cast((l_orderkey*31+l_partkey*17+l_linenumber*101) % 99000 as bigint) as start_pos,
        cast((l_orderkey*31+l_partkey*17+l_linenumber*101) % 99000 + 50 + cast(l_quantity as bigint) as bigint) as end_pos, cast(round(l_discount*600) as int) mapq,
        cast(case when l_returnflag='R' then 1024 else 0 end + case when l_suppkey % 2 = 0 then 16 else 0 end + case when l_partkey % 50 = 0 then 4 else 0 end
        + 1 + case when l_partkey % 7 <> 0 then 2 else 0 end as int) flag from lineitem""",
    "sam": f"""select concat('p', cast(l_orderkey as string), '_', cast(l_partkey as string), '_', cast(l_linenumber as string)) qname,
        case when l_linestatus='O' then 'tumor' else 'normal' end sample, concat('chr', cast(l_suppkey % 5 + 1 as string)) chrom,
        cast((l_orderkey*31+l_partkey*17+l_linenumber*101) % 2000 + 1 as bigint) as pos, cast(round(l_discount*600) as int) mapq,
        case l_linenumber % 4 when 0 then '32M' when 1 then '5S27M' when 2 then '10M2D20M2S' else '12M3I17M' end cigar,
        translate(md5(cast(l_partkey as string)), {_H}, 'ACGTACGTACGTACGN') seq, translate(reverse(md5(cast(l_partkey as string))), {_H}, '#+5?IIIIFFFF:,AB') qual,
        cast(150 + l_orderkey % 300 as int) tlen,
        cast(1 + case when l_partkey % 7 <> 0 then 2 else 0 end + case when l_suppkey % 2 = 0 then 16 else 32 end + case when l_orderkey % 2 = 0 then 64 else 128 end
        + case when l_partkey % 50 = 0 then 4 else 0 end as int) flag from lineitem""",
    "pairs_sam": f"""select concat('f', cast(l_orderkey as string), ':', cast(cast(floor((l_linenumber + 1) / 2) as bigint) as string)) qname,
        case when l_orderkey % 3 = 0 then 'tumor' else 'normal' end sample, concat('chr', cast(l_orderkey % 5 + 1 as string)) chrom,
        cast((l_orderkey*31 + (cast(floor((l_linenumber + 1) / 2) as bigint))*101) % 2000 + 1 + case when l_linenumber % 2 = 0 then l_orderkey % 45 else 0 end as bigint) as pos, 60 mapq,
        case l_orderkey % 3 when 0 then '32M' when 1 then '5S27M' else '10M2D20M2S' end cigar,
        translate(md5(cast(l_partkey as string)), {_H}, 'ACGTACGTACGTACGN') seq, translate(reverse(md5(cast(l_partkey as string))), {_H}, '#+5?IIIIFFFF:,AB') qual,
        cast(case when l_linenumber % 2 = 0 then 1 + 2 + 16 + 128 else 1 + 2 + 32 + 64 end as int) flag from (select l_orderkey, l_linenumber, max(l_partkey) l_partkey from lineitem group by l_orderkey, l_linenumber) l""",
    "variants": """select concat('chr', cast(p_partkey % 5 + 1 as string)) chrom, cast((p_partkey*7907) % 99000 + 1 as bigint) as pos,
        substr('ACGT', cast(p_partkey % 4 + 1 as int), 1) ref,
        case when p_size % 10 = 0 then concat(substr('ACGT', cast(p_partkey % 4 + 1 as int), 1), 'GG') else substr('CGTA', cast(p_partkey % 4 + 1 as int), 1) end alt,
        case when p_partkey % 3 = 0 then 'germline' else 'PASS' end filt, cast(p_size*2 as int) as dp, cast(p_partkey % (p_size+1) as int) as ad_alt from part""",
    "vcf_lines": """select concat_ws(chr(9), chrom, cast(pos as string), '.', ref, alt, '50', filt, concat('DP=', cast(dp as string), ';CSQ=', alt, '|',
        case when pos % 9 = 0 then 'missense_variant' when pos % 9 = 1 then 'stop_gained' when pos % 9 = 2 then 'frameshift_variant' when pos % 9 = 3 then 'synonymous_variant'
        when pos % 9 = 4 then 'splice_region_variant' when pos % 9 = 5 then 'intron_variant' when pos % 9 = 6 then 'intergenic_variant' when pos % 9 = 7 then 'inframe_insertion' else 'inframe_deletion' end, '|G', cast(pos % 50 as string)), 'GT:AD:DP',
        concat('0/1:', cast(dp - ad_alt as string), ',', cast(ad_alt as string), ':', cast(dp as string))) as value from variants""",
    "fastq": f"""select cast(o_orderkey as bigint) as rec, concat('@q', cast(o_orderkey as string), '/1 lane') as header, translate(md5(cast(o_orderkey as string)), {_H}, 'ACGTACGTACGTACGN') seq,
        '+' plus, translate(reverse(md5(cast(o_orderkey as string))), {_H}, '#+5?IIIIFFFF:,AB') qual from orders""",
    "fastq2": """select rec, case when rec % 101 = 0 then concat('@x', cast(rec as string), '/2') else replace(header, '/1', '/2') end header, seq, case when rec % 997 = 0 then '-' else plus end plus,
        case when rec % 499 = 0 then concat(qual, 'I') else qual end qual from fastq""",
    "qc_long": """select concat('PRLC_', cast(user_id % 20 as string), case when user_id % 2 = 0 then '_SCC_' else '_Kidney_' end, cast(user_id % 3 as string)) sample,
        event_type metric, value from events""",
    "pairs": "select distinct sample tumor, regexp_replace(sample, '_SCC_.*', '_Kidney') normal from qc_long where sample like '%SCC%'",
    "loads": """select sample, cast(count(*) as bigint) n_total, cast(sum(case when value > 50 then 1 else 0 end) as bigint) n_snv, cast(sum(case when value <= 50 then 1 else 0 end) as bigint) n_indel,
        cast(count(distinct metric) * 2.5 as double) callable_mb from qc_long group by sample""",
}

TABLES = ("region", "orders", "lineitem", "part", "events")


def with_views(body: str, recursive: bool = False) -> str:
    """``body`` after the definitions of all views."""
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{k} as ({v})" for k, v in VIEWS.items()) + "\n" + body


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of a folder; Catalyst drops the definitions that it does not need."""
    sql = with_views(f"select * from {name}")
    return spark.sql(re.sub(rf"\bfrom ({'|'.join(TABLES)})\b", lambda m: f"from parquet.`{sf_dir}/{m[1]}.parquet`", sql))
