"""SQL counterparts of the queries, for DuckDB over the same tables.

Queries without an entry score bases with the alignment HMM, whose recurrences over every read
and reference base are too slow in SQL on whole tables; tests check them by brute force.
"""

from __future__ import annotations

from readloom.catalog.derived import AT_QUALITIES, HEX, QUALITIES, READ_BASES, REF_BASES, SECOND_FILE


def _letters(tag: str, letters: str) -> str:
    return f"translate(concat(md5(concat('{tag}0', key)), md5(concat('{tag}1', key))), '{HEX}', '{letters}')"


def _reads(varied: bool = False, qualities: str = QUALITIES, mates: bool = False) -> str:
    name = "concat(l_orderkey, '.', l_linenumber // 2, '/', 1 + l_linenumber % 2)" if mates else "key"
    size = "cast(24 + l_partkey % 41 as integer)" if varied else "64"
    return f"""
    keyed as (
      select concat(cast(l_orderkey as varchar), '/', cast(l_linenumber as varchar)) as key, *
      from lineitem),
    reads as (
      select concat('@R', {name}) as header,
             substr({_letters('b', READ_BASES)}, 1, {size}) as bases,
             substr({_letters('q', qualities)}, 1, {size}) as qual,
             l_orderkey, l_linenumber, l_suppkey, l_partkey
      from keyed)"""


READS, VARIED, MATES = _reads(), _reads(varied=True), _reads(mates=True)
FILED = _reads(varied=True, qualities=AT_QUALITIES)

REF = f"""
    ref as (
      select concat('chr', cast(r_regionkey + 1 as varchar)) as chrom,
             translate(array_to_string(list_transform(range(0, 20),
               lambda i: md5(concat('r', cast(r_regionkey as varchar), '/', cast(i as varchar)))), ''),
               '{HEX}', '{REF_BASES}') as seq
      from region)"""

ALN = f"""{READS}, {REF},
    placed as (
      select concat('chr', cast(1 + l_suppkey % 5 as varchar)) as chrom,
             cast(1 + (l_partkey * 7 + l_linenumber) % 500 as integer) as pos,
             l_orderkey % 4 as v, header, qual, l_orderkey, l_linenumber
      from reads),
    aln as (
      select header, p.chrom, pos, 60 as mapq,
             case v when 0 then '64M' when 1 then '30M2I32M' when 2 then '30M3D34M' else '4S60M' end as cigar,
             case v when 0 then concat(substr(seq, pos, 20), translate(substr(seq, pos + 20, 1), 'ACGT', 'CGTA'),
                                       substr(seq, pos + 21, 43))
                    when 1 then concat(substr(seq, pos, 30), 'GT', substr(seq, pos + 30, 32))
                    when 2 then concat(substr(seq, pos, 30), substr(seq, pos + 33, 34))
                    else concat('NNNN', substr(seq, pos, 60)) end as bases,
             qual, seq, l_orderkey, l_linenumber,
             case when l_orderkey % 17 = 0 then '*' else p.chrom end as shown
      from placed p join ref r on p.chrom = r.chrom)"""

OPS = f"""{ALN},
    kinds as (
      select cigar, regexp_extract_all(cigar, '([0-9]+)([MIDNSHPX=])', 1) as lens,
             regexp_extract_all(cigar, '([0-9]+)([MIDNSHPX=])', 2) as letters
      from (select distinct cigar from aln)),
    items as (
      select cigar, cast(i as integer) as op_index, cast(lens[i + 1] as integer) as len, letters[i + 1] as op
      from kinds, lateral (select unnest(range(len(lens))) as i)),
    ops as (
      select *,
        cast(coalesce(sum(case when op in ('M', 'I', 'S', '=', 'X') then len else 0 end) over w, 0) as integer) as read_off,
        cast(coalesce(sum(case when op in ('M', 'D', 'N', '=', 'X') then len else 0 end) over w, 0) as integer) as ref_off,
        cast(coalesce(sum(case when op in ('M', 'I', 'D', 'N', '=', 'X') then len else 0 end) over w, 0) as integer) as col_off
      from items
      window w as (partition by cigar order by op_index rows between unbounded preceding and 1 preceding))"""

HIST = f"""{VARIED},
    hist as (
      select cast(cycle as integer) as cycle, cast(ord(substr(qual, cycle, 1)) - 33 as integer) as q, count(*) as n
      from (select qual, unnest(range(1, length(qual) + 1)) as cycle from reads)
      group by all)"""


def _two(x: str) -> str:
    return f"cast(printf('%.2f', cast({x} as double)) as double)"


def _text(x: str) -> str:
    return f"regexp_replace(printf('%.2f', cast({x} as double)), '^0\\.', '.')"


SHARES = (10, 25, 50, 75, 90)
STATS = [f"p{s}" for s in SHARES] + ["avg_q"]

QUANT = f"""{HIST},
    running as (
      select *, sum(n) over (partition by cycle order by q desc) as at_least, sum(n) over (partition by cycle) as total
      from hist),
    quant as (
      select cycle, cast(sum(n) as bigint) as n,
        {', '.join(f"max(q) filter (where at_least * 100 >= total * {s}) as p{s}" for s in SHARES)},
        {_two('cast(sum(q * n) as double) / cast(sum(n) as double)')} as avg_q
      from running group by cycle)"""

AVG = """
    avgq as (
      select cast(sum(q * n) as double) / cast(sum(n) as double) as avg_quality,
             (select cast(floor(sum(floor(avg_q)) / count(*)) as bigint) from quant) as avg_quality_trunc
      from hist)"""

BOX = f"""{QUANT},
    grouped as (
      select case when cycle <= 9 then cycle else 10 + 5 * ((cycle - 10) // 5) end as grp, * from quant),
    box as (
      select case when count(*) = 5 then min(cycle) else max(cycle) end as first_cycle, max(cycle) as last_cycle,
        {', '.join(f"case when count(*) = 5 then {_two(f'sum(cast({s} as double)) / 5')} else cast(arg_max({s}, cycle) as double) end as {s}" for s in STATS)}
      from grouped group by grp)"""

SUMMARY = f"""
    summary as (
      select count(*) as reads, cast(sum(length(bases)) as bigint) as bases,
        cast(sum(length(bases) - length(replace(replace(bases, 'G', ''), 'C', ''))) as bigint) as gc_bases,
        cast(min(length(bases)) as bigint) as min_len, cast(max(length(bases)) as bigint) as max_len,
        {_two("cast(sum(length(bases) - length(replace(replace(bases, 'G', ''), 'C', ''))) as double) / cast(sum(length(bases)) as double) * 100")} as gc_pct
      from reads)"""

PAIRS = f"""{MATES},
    named as (select split_part(header, '/', 1) as read_name, split_part(header, '/', 2) as mate, * from reads),
    pairs as (
      select read_name,
        {', '.join(f"max({c}) filter (where mate = '{m}') as {c}{m}" for m in (1, 2) for c in ('header', 'bases', 'qual'))}
      from named group by read_name
      having count(*) = 2 and count(*) filter (where mate = '1') = 1 and count(*) filter (where mate = '2') = 1)"""


def _fastq(m: int) -> str:
    return f"concat_ws(chr(10), header{m}, bases{m}, '+', qual{m})"


def _trim(good: str, cut_min: int, uncut_min: int) -> str:
    return f"""with {VARIED},
    prefix as (select *, length(regexp_extract(qual, '^[{good}]*')) as g from reads)
    select header, substr(bases, 1, g) as bases, substr(qual, 1, g) as qual, cast(g as integer) as kept_len
    from prefix where g >= case when g < length(qual) then {cut_min} else {uncut_min} end"""


def _pileup(min_ord: int, where: str = "true") -> str:
    return f"""{OPS},
    based as (
      select a.chrom, pos + ref_off + j as pos, substr(seq, pos + ref_off + j, 1) as ref,
             substr(bases, read_off + j + 1, 1) as base, ord(substr(qual, read_off + j + 1, 1)) as o
      from (select *, unnest(range(len)) as j from aln join ops using (cigar) where op = 'M' and {where}) a),
    pile as (
      select chrom, cast(pos as integer) as pos, ref, count(*) as total,
        count(*) filter (where base = 'A') as a, count(*) filter (where base = 'T') as t,
        count(*) filter (where base = 'C') as c, count(*) filter (where base = 'G') as g,
        count(*) filter (where base not in ('A', 'T', 'C', 'G')) as n
      from based where o >= {min_ord} group by all)"""


SAM_LINE = """concat_ws(chr(9), substr(header, 2), '0', shown, cast(pos as varchar), '60', cigar, '*', '0', '0',
             bases, qual, concat('XO:i:', cast(l_orderkey as varchar)))"""

HEADER = f"""{REF},
    head as (
      select concat_ws(chr(9), '@HD', 'VN:1.4', 'SO:unsorted') as line from ref
      union all
      select concat_ws(chr(9), '@SQ', 'SN:' || chrom, 'LN:' || cast(length(seq) as varchar)) from ref)"""

NOT_STAR = "shown <> '*'"

_REFERENCED = f"""with {OPS},
    spans as (select cigar, cast(sum(len) as integer) as span from ops where op in ('M', 'D', 'N') group by cigar)
    select chrom, pos, cigar, bases, substr(seq, pos, span) as ref_seq from aln join spans using (cigar)"""

ORACLES: dict[str, str] = {
    "qc_summary": f"with {VARIED}, {SUMMARY} select * from summary",
    "phred_long": f"""with {VARIED},
        long as (select header, cycle, ord(substr(qual, cycle, 1)) - 33 as q
                 from (select header, qual, unnest(range(1, length(qual) + 1)) as cycle from reads))
        select header, count(*) as n, cast(sum(q) as bigint) as sum_q, cast(sum(q * cycle) as bigint) as sum_q_cycle
        from long group by header""",
    "phred_offset": f"""with {READS},
        decisive as (select regexp_extract(qual, '[!-4U-~]') as ch, l_orderkey, l_linenumber from reads)
        select cast(coalesce((select case when ch < '5' then 33 else 64 end from decisive where ch <> ''
                              order by l_orderkey, l_linenumber limit 1), 0) as integer) as "offset" """,
    "phred_offset_head": f"""with {READS},
        head as (select * from reads order by l_orderkey, l_linenumber limit 20),
        decisive as (select regexp_extract(qual, '[!-4U-~]') as ch, l_orderkey, l_linenumber from head)
        select cast(coalesce((select case when ch < '5' then 33 else 64 end from decisive where ch <> ''
                              order by l_orderkey, l_linenumber limit 1), 0) as integer) as "offset" """,
    "cycle_quality_hist": f"with {HIST} select * from hist",
    "cycle_quantiles": f"with {QUANT} select * from quant",
    "avg_quality": f"with {QUANT}, {AVG} select * from avgq",
    "qc_boxplot": f"with {BOX} select * from box",
    "qc_report_lines": f"""with {BOX}, {SUMMARY}, {AVG}
        select 1 as line_no, 'Measure value ' as line
        union all select 2, 'Filename:lineitem '
        union all select 3, concat('Total reads:', cast(reads as varchar), ' ') from summary
        union all select 4, concat('Total Sequences:', cast(bases as varchar), ' ') from summary
        union all select 5, concat('Sequence length:', case when min_len = max_len
            then concat(cast(max_len as varchar), ' ')
            else concat(cast(min_len as varchar), '-', cast(max_len as varchar), '  ') end) from summary
        union all select 6, concat('Average quality:', {_text('avg_quality_trunc')}, ' ') from avgq
        union all select 7, concat('%GC:', {_text('gc_pct')}, ' ') from summary
        union all select 8, '----------For Box plot----------'
        union all select cast(8 + case when last_cycle <= 9 then last_cycle else 10 + (last_cycle - 10) // 5 end as integer),
          concat(case when first_cycle = last_cycle then concat(cast(last_cycle as varchar), chr(9))
                      else concat(cast(first_cycle as varchar), '-', cast(last_cycle as varchar), ' ') end,
                 concat_ws(' ', {', '.join(_text(s) for s in STATS)})) from box""",
    "read_keys": f"""with {READS},
        styled as (select case l_linenumber % 3 when 0 then header when 1 then replace(header, '/', '_')
                          else concat(replace(header, '/', ' '), ':N:0:X') end as header,
                          case l_linenumber % 3 when 0 then '/' when 1 then '_' else ' ' end as sep from reads)
        select header, split_part(header, sep, 1) as read_name,
               cast(substr(split_part(header, sep, 2), 1, 1) as integer) as mate from styled""",
    "header_separator": f"""with {READS}
        select case when contains(header, '_') then '_' when contains(header, '/') then '/' else ' ' end as sep
        from reads order by l_orderkey, l_linenumber limit 1""",
    "trim_reads": _trim("5-~", 30, 31),
    "trim_reads_strict": _trim(";-~", 24, 24),
    "reads_union": f"with {MATES} select header, bases, qual from reads",
    "reads_per_name": f"with {READS} select split_part(header, '/', 1) as read_name, count(*) as n from reads group by 1",
    "mate_pairs_grouped": f"with {PAIRS} select * from pairs",
    "mate_pairs_joined": f"""with {PAIRS}
        select x.read_name, x.header as header1, x.bases as bases1, x.qual as qual1,
               y.header as header2, y.bases as bases2, y.qual as qual2
        from named x join named y on x.read_name = y.read_name and x.mate = '1' and y.mate = '2'""",
    "interleaved_pairs": f"with {PAIRS} select read_name, concat_ws(chr(10), {_fastq(1)}, {_fastq(2)}) as value from pairs",
    "paired_fastq_mate1": f"with {PAIRS} select {_fastq(1)} as value from pairs",
    "paired_fastq_mate2": f"with {PAIRS} select {_fastq(2)} as value from pairs",
    "trimmed_pairs": f"""with {MATES},
        prefix as (select *, length(regexp_extract(qual, '^[5-~]*')) as g from reads),
        kept as (select header, substr(bases, 1, g) as bases, substr(qual, 1, g) as qual,
                        split_part(header, '/', 1) as read_name, split_part(header, '/', 2) as mate
                 from prefix where g >= case when g < length(qual) then 10 else 11 end)
        select read_name, {', '.join(f"max({c}) filter (where mate = '{m}') as {c}{m}" for m in (1, 2) for c in ('header', 'bases', 'qual'))}
        from kept group by read_name
        having count(*) = 2 and count(*) filter (where mate = '1') = 1 and count(*) filter (where mate = '2') = 1""",
    "fastq_records": f"with {FILED} select header, bases, qual from reads",
    "fastq_record_numbers": "select count(*) as reads, true as dense from lineitem",
    "fastq_source_validated": f"with {FILED} select header, bases, qual from reads",
    "fastq_compare": f"""with {FILED},
        second as (select header, bases, qual from reads where {SECOND_FILE})
        select count(*) as reads_first, (select count(*) from second) as reads_second,
               count(*) filter (where (header, bases, qual) in (select (header, bases, qual) from second)) as reads_common
        from reads""",
    "sam_split_counts": """select (select 2 * count(*) from region) as header_lines,
               (select count(*) from lineitem) as body_lines""",
    "sam_header_sorted": f"with {HEADER} select distinct replace(line, 'unsorted', 'sorted') as line from head",
    "mapped_reads": f"""with {ALN}
        select substr(header, 2) as qname, 0 as flag, shown as rname, pos, mapq, cigar, bases as seq, qual,
               concat('XO:i:', cast(l_orderkey as varchar)) as tag
        from aln where shown <> '*'""",
    "coordinate_sort": f"""with {ALN}
        select shown as rname, pos, substr(header, 2) as qname, cigar,
               row_number() over (partition by shown order by pos, substr(header, 2)) as rank
        from aln where shown <> '*'""",
    "partition_by_id": """select k, cast(coalesce(k, 0) % 4 as integer) as part, count(*) as n
        from (select case when l_linenumber < 7 then l_linenumber end as k from lineitem) group by 1, 2""",
    "pipe_lines": f"with {PAIRS} select unnest(string_split(concat_ws(chr(10), {_fastq(1)}, {_fastq(2)}), chr(10))) as value from pairs",
    "sam_partition_blocks": f"""with {ALN}
        select {SAM_LINE} as value, (select count(*) + 1 from ref) as header_lines, true as led, true as in_order
        from aln where shown <> '*'""",
    "pileup_by_region": f"""with {ALN}
        select concat_ws(chr(9), shown, cast(pos as varchar), cast(count(*) as varchar)) as value
        from aln where shown <> '*' group by shown, pos""",
    "reference_bases": f"""with {REF}
        select chrom, cast(i as integer) as pos, substr(seq, i, 1) as ref
        from (select chrom, seq, unnest(range(1, length(seq) + 1)) as i from ref)""",
    "alignments_valid": f"with {ALN} select chrom, pos, mapq, cigar, bases, qual from aln where shown <> '*'",
    "reads_with_reference": _REFERENCED,
    "reads_with_reference_tiled": _REFERENCED,
    "cigar_ops": f"""with {OPS}
        select chrom, pos, cigar, op_index, len, op, read_off, ref_off from aln join ops using (cigar)""",
    "aligned_columns": f"""with {OPS},
        cols as (
          select chrom, pos, col_off + j as col, op,
            case when op = 'I' then '_' else substr(seq, pos + ref_off + j, 1) end as ref,
            case when op = 'D' then '_' else substr(bases, read_off + j + 1, 1) end as base
          from (select *, unnest(range(len)) as j from aln join ops using (cigar) where op <> 'S'))
        select chrom, op, ref, base, count(*) as n, cast(sum(col) as bigint) as sum_col,
               cast(sum(col * pos) as bigint) as sum_col_pos
        from cols group by all""",
    "pileup_counts": f"with {_pileup(53)} select * from pile",
    "locus_count_lines": f"""with {_pileup(53)}
        select concat_ws(' ', chrom, {', '.join(f'cast({c} as varchar)' for c in ('pos', 'ref', 'total', 'a', 't', 'c', 'g', 'n'))}) as value
        from pile""",
    "sam_pileup": f"with {_pileup(33, NOT_STAR)} select * from pile",
}

_KEPT = f"""{MATES},
        prefix as (select *, length(regexp_extract(qual, '^[5-~]*')) as g from reads),
        kept as (select header, substr(bases, 1, g) as bases, substr(qual, 1, g) as qual,
                        split_part(header, '/', 1) as read_name, split_part(header, '/', 2) as mate
                 from prefix where g >= case when g < length(qual) then 10 else 11 end)"""

_PLACED = f"""trimmed as ({ORACLES['trimmed_pairs']}),
    mates as (select read_name, bases1 as bases, qual1 as qual from trimmed
              union all select read_name, bases2, qual2 from trimmed)"""


def _report_of(reads: str, name: str) -> str:
    lines = ORACLES["qc_report_lines"].replace(VARIED, reads)
    return f"select replace(line, 'Filename:lineitem', 'Filename:{name}') as value from ({lines})"


ORACLES |= {
    "job_qc": _report_of(FILED, "fastq"),
    "job_trim_pair": f"""with {_KEPT},
        joined as (select x.header as h1, x.bases as b1, x.qual as q1, y.header as h2, y.bases as b2, y.qual as q2
                   from kept x join kept y on x.read_name = y.read_name and x.mate = '1' and y.mate = '2')
        select h1 as header, b1 as bases, q1 as qual from joined union all select h2, b2, q2 from joined""",
    "job_trim_counts": f"""with {_KEPT},
        named as (select split_part(header, '/', 2) as mate from reads)
        select {', '.join(f"(select count(*) from {t} where mate = '{m}') as {c}{m}" for m in (1, 2) for t, c in (('named', 'reads'), ('kept', 'kept')))},
               (select count(*) from ({ORACLES['trimmed_pairs']})) as pairs""",
    "job_qc_and_trim": f"""with trimmed as ({ORACLES['trimmed_pairs']})
        {' union all '.join(f"select 'mate{m}' as part, unnest([header{m}, bases{m}, '+', qual{m}]) as value from trimmed" for m in (1, 2))}
        union all select 'report', value from ({_report_of(MATES.replace('from keyed', 'from keyed where 1 + l_linenumber % 2 = 1'), 'mate1')})""",
    "job_align": f"""with {_PLACED}
        select concat_ws(chr(9), substr(read_name, 2), '0', 'chr1', cast(length(bases) as varchar), '60',
                         concat(cast(length(bases) as varchar), 'M'), '*', '0', '0', bases, qual) as value from mates""",
    "job_full_chain": f"""with {_PLACED}, {REF},
        based as (select length(bases) + j as pos, substr(bases, j + 1, 1) as base
                  from (select bases, unnest(range(length(bases))) as j from mates))
        select 'chr1' as chrom, cast(pos as integer) as pos, substr(seq, cast(pos as integer), 1) as ref, count(*) as total,
          count(*) filter (where base = 'A') as a, count(*) filter (where base = 'T') as t,
          count(*) filter (where base = 'C') as c, count(*) filter (where base = 'G') as g,
          count(*) filter (where base not in ('A', 'T', 'C', 'G')) as n
        from based, ref where ref.chrom = 'chr1' group by pos, seq""",
    "depth_by_region": f"""with {_pileup(0, NOT_STAR)}
        select concat_ws(chr(9), chrom, cast(pos as varchar), cast(total as varchar)) as value
        from (select chrom, pos, sum(total)::bigint as total from pile group by chrom, pos)""",
    "locus_store": f"with {_pileup(53)} select * from pile",
}
