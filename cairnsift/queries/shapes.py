"""Input shapes over the driver's tables (SQL both engines read)."""

from __future__ import annotations

from cairnsift.queries.registry import Dialect, shape


@shape("listing")
def listing(d: Dialect) -> str:
    """An archive listing: one row per line item, with two separators, vendor folders and copies."""
    return f"""
SELECT concat('arc', l_returnflag, l_linestatus, '.zip') AS archive,
       concat('batch', {d.text('l_suppkey')},
              CASE WHEN l_linestatus = 'O' THEN '/' ELSE chr(92) END,
              CASE l_returnflag WHEN 'A' THEN 'POS' WHEN 'N' THEN 'neg_C18' ELSE 'mix' END,
              '/S', {d.text('l_orderkey')}, '_', {d.text('l_linenumber')},
              CASE WHEN l_linestatus = 'O' THEN '_pos' ELSE '_neg' END,
              CASE cast(floor(l_discount * 100 + 0.5) AS int)
                   WHEN 0 THEN '.raw' WHEN 1 THEN '.mzML' WHEN 2 THEN '.mzXML' WHEN 3 THEN '.d/AcqData/MSScan.bin'
                   WHEN 4 THEN '.wiff' WHEN 5 THEN '.txt' WHEN 6 THEN '.zip' WHEN 7 THEN '.RAW'
                   WHEN 8 THEN '.cdf' WHEN 9 THEN '.raw/_FUNC001.DAT' ELSE '' END) AS path,
       cast(l_quantity AS bigint) * 100 AS size,
       lower(hex(l_partkey * 64 + cast(l_quantity AS bigint))) AS crc32,
       CASE WHEN l_tax = 0.08 THEN 'dir' ELSE 'file' END AS type,
       l_orderkey, l_linenumber
FROM {d.table('lineitem')}"""


@shape("member", "listing")
def member(d: Dialect) -> str:
    """The listing with the files kept and the checksum in its canonical form."""
    return """
SELECT archive, path, size, lpad(upper(crc32), 8, '0') AS crc32 FROM listing WHERE type = 'file' OR type = ''"""


@shape("catalog_row")
def catalog_row(d: Dialect) -> str:
    """Sample rows: one per order; the unit is the customer, the row index the order key."""
    return f"""
SELECT concat('U', {d.text('o_custkey')}) AS unit_id, o_orderkey AS row_index,
       concat('S', {d.text('o_orderkey')}) AS sample_id,
       concat('S', {d.text('o_orderkey')},
              CASE o_orderstatus WHEN 'O' THEN '_1_pos.raw' WHEN 'F' THEN '_2_neg' ELSE '_3_pos.mzML' END) AS raw_file,
       o_orderstatus, o_orderpriority, o_totalprice
FROM {d.table('orders')}"""


@shape("unit")
def unit(d: Dialect) -> str:
    """Planning units: one per order, with a tri-state flag and an instrument text."""
    return f"""
SELECT concat('U', {d.text('o_orderkey')}) AS unit_id, o_orderkey,
       concat('R', {d.text('c_nationkey')}) AS repository, concat('A', {d.text('o_custkey')}) AS accession,
       CASE WHEN o_orderstatus = 'P' THEN 'GC-MS' ELSE 'LC-MS' END AS separation,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DDA' WHEN '2' THEN 'DIA' WHEN '3' THEN 'AIF'
            WHEN '4' THEN 'SWATH' ELSE 'Unknown' END AS acquisition_mode,
       CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN NULL ELSE 1 END AS untargeted,
       CASE WHEN c_acctbal < 0 THEN 'Unknown' WHEN c_acctbal < 3000 THEN 'Positive' WHEN c_acctbal < 6000 THEN 'Negative'
            ELSE 'Both' END AS ion_mode,
       CASE WHEN c_nationkey < 3 THEN 'Bruker timsTOF Pro' WHEN c_nationkey < 8 THEN 'SCIEX ZenoTOF 7600'
            WHEN c_nationkey < 12 THEN 'Thermo' WHEN c_nationkey < 18 THEN 'Thermo Orbitrap Fusion'
            WHEN c_nationkey < 22 THEN 'unknown' ELSE 'Agilent 6545' END AS instrument,
       o_orderstatus, o_orderdate, cast(floor(o_totalprice * 100 + 0.5) AS bigint) AS price_cents
FROM {d.table('orders')} JOIN {d.table('customer')} ON o_custkey = c_custkey"""


@shape("raw_file")
def raw_file(d: Dialect) -> str:
    """Listed files of a unit; a size is unknown where nothing was taxed, a URL missing at the highest discount."""
    return f"""
SELECT concat('U', {d.text('l_orderkey')}) AS unit_id, l_orderkey, l_linenumber,
       concat('f', {d.text('l_orderkey')}, '_', {d.text('l_linenumber')},
              CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '_EAD' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '_7ead9f3c'
                   WHEN l_linenumber = 7 THEN '_ETD2' ELSE '' END,
              CASE WHEN l_quantity <= 15 THEN '.mzData' WHEN l_quantity <= 25 THEN '.mzdata.xml' ELSE '.raw' END) AS path,
       CASE WHEN l_returnflag = 'R' THEN 'metadata' WHEN l_linestatus = 'O' THEN 'raw' ELSE 'converted' END AS role,
       CASE WHEN l_tax = 0 THEN NULL ELSE cast(l_quantity AS bigint) * 1000 END AS size_bytes,
       CASE WHEN l_discount >= 0.1 THEN NULL ELSE concat('https://store/', {d.text('l_partkey')}, '/', {d.text('l_suppkey')}) END AS download_url,
       CASE WHEN l_linestatus = 'F' THEN 'archive' WHEN l_returnflag = 'N' THEN 'bundle' ELSE 'file' END AS kind,
       concat('o', {d.text('l_partkey')}, '-', {d.text(d.div(d.us('l_shipdate'), '86400000000'))}) AS object_id,
       l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus
FROM {d.table('lineitem')}"""


@shape("payload")
def payload(d: Dialect) -> str:
    """Decision documents, one per order."""
    return f"""
SELECT concat('U', {d.text('o_orderkey')}) AS unit_id, o_orderkey, concat('A', {d.text('o_custkey')}) AS accession,
       CASE WHEN o_orderstatus = 'O' THEN 'ready' WHEN o_orderstatus = 'F' AND o_totalprice < 150000 THEN 'abstained'
            WHEN o_orderstatus = 'F' THEN 'needs_person' ELSE 'excluded' END AS status,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'positive' WHEN '2' THEN 'negative' WHEN '3' THEN 'both'
            WHEN '4' THEN 'switching' ELSE 'unknown' END AS ion_mode,
       CASE WHEN o_totalprice < 120000 THEN 'HILIC' WHEN o_totalprice < 400000 THEN 'RP' ELSE 'unknown' END AS chromatography,
       CASE WHEN o_totalprice < 200000 THEN 'DDA' WHEN o_totalprice < 300000 THEN 'DIA' ELSE 'mixed' END AS acquisition_mode,
       CASE WHEN o_orderstatus <> 'P' THEN NULL WHEN o_totalprice < 160000 THEN 'no_product_ion_files'
            WHEN o_totalprice < 320000 THEN 'no_files' WHEN o_totalprice < 450000 THEN 'shared_content_unassigned' END AS exclusion_reason,
       CASE WHEN o_totalprice < 50000 THEN '1.2.9' WHEN o_totalprice < 60000 THEN 'dev' ELSE '1.3.0' END AS skill_version,
       7 AS catalog_row_count
FROM {d.table('orders')}"""


@shape("item")
def item(d: Dialect) -> str:
    """Kept and excluded items of the documents: one per line item."""
    return f"""
SELECT concat('U', {d.text('l_orderkey')}) AS unit_id, l_orderkey,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'excluded_member' WHEN l_returnflag = 'R' THEN 'excluded_row'
            WHEN l_linenumber = 7 THEN 'added_member' ELSE 'row' END AS kind,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_linenumber AS bigint) - 1 END AS row_index,
       concat('S', {d.text('l_partkey')}) AS sample_id,
       concat('f', {d.text('l_partkey')}, CASE WHEN l_linestatus = 'O' THEN '.raw' ELSE '.mzXML' END) AS raw_file,
       CASE WHEN l_linenumber = 7 OR l_suppkey > 10 THEN
            concat('run', {d.text('l_suppkey')}, '/f', {d.text('l_partkey')},
                   CASE WHEN l_quantity > 25 THEN '_pos' WHEN l_quantity > 10 THEN '_neg_C18_DIA' ELSE '' END,
                   CASE WHEN l_linestatus = 'O' THEN '.raw' ELSE '.mzXML' END) END AS member_path,
       CASE WHEN l_quantity > 20 THEN 'positive' WHEN l_quantity > 4 THEN 'negative' WHEN l_quantity > 2 THEN 'switching'
            ELSE 'unknown' END AS ion_mode,
       CASE WHEN l_tax < 0.02 THEN 'HILIC' WHEN l_tax < 0.07 THEN 'RP' ELSE 'unknown' END AS chromatography,
       CASE WHEN l_discount < 0.04 THEN 'DDA' WHEN l_discount < 0.06 THEN 'DIA' WHEN l_discount < 0.08 THEN 'MS1'
            WHEN l_discount < 0.1 THEN 'targeted_DDA' ELSE 'unknown' END AS acquisition_mode,
       CASE WHEN l_linestatus = 'O' THEN 'declared' ELSE 'inferred' END AS basis,
       CASE WHEN l_discount < 0.03 THEN 'low' WHEN l_discount < 0.08 THEN 'medium' ELSE 'high' END AS confidence,
       CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_discount < 0.02 THEN 'belongs_to_other_unit' WHEN l_discount < 0.03 THEN 'needs_person'
            WHEN l_discount < 0.04 THEN 'no_signal_abstained' WHEN l_discount < 0.05 THEN 'polarity_switching'
            WHEN l_discount < 0.06 THEN 'ms1_only_no_msms' WHEN l_discount < 0.07 THEN 'requires_conversion'
            WHEN l_discount < 0.08 THEN 'not_in_archive' WHEN l_discount < 0.09 THEN 'duplicate_content'
            WHEN l_discount < 0.1 THEN 'shared_content_unassigned' ELSE 'other' END AS reason,
       CASE WHEN l_returnflag = 'R' AND l_discount < 0.02 THEN
            CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.01 THEN concat('U', {d.text('l_orderkey')})
                 ELSE concat('U', {d.text('l_orderkey + 1')}) END END AS belongs_to_unit,
       CASE WHEN l_quantity > 40 THEN 'sample' WHEN l_quantity > 5 THEN 'qc' ELSE 'blank' END AS role,
       CASE WHEN l_tax < 0.04 THEN 'catalog_row' WHEN l_tax < 0.06 THEN 'archive_listing' ELSE 'raw_header' END AS source,
       CASE WHEN l_quantity > 30 THEN 'size' WHEN l_quantity > 15 THEN 'polarity' ELSE 'path' END AS field,
       CASE WHEN l_tax >= 0.06 AND l_quantity > 15 THEN CASE WHEN l_quantity > 27 THEN 'POS' ELSE 'negative' END ELSE 'x' END AS value
FROM {d.table('lineitem')}"""


@shape("flag")
def flag(d: Dialect) -> str:
    """Flags of the documents; those of dear line items say nothing."""
    return f"""
SELECT DISTINCT concat('U', {d.text('l_orderkey')}) AS unit_id,
       CASE WHEN l_quantity > 10 THEN 'seen_before' WHEN l_tax = 0 THEN 'shared_content' WHEN l_tax = 0.01 THEN 'polarity_switching' WHEN l_tax = 0.02 THEN 'ms1_only'
            WHEN l_tax = 0.03 THEN 'mixed_acquisition' WHEN l_tax = 0.04 THEN 'name_token_disputed'
            WHEN l_tax = 0.05 THEN 'declared_technical_disputed' WHEN l_tax = 0.06 THEN 'ms1_only_excluded'
            ELSE 'targeted_dda' END AS code,
       CASE WHEN l_linestatus = 'O' THEN 'confirmed' ELSE 'suspected' END AS certainty
FROM {d.table('lineitem')}"""


@shape("question")
def question(d: Dialect) -> str:
    return f"""
SELECT DISTINCT concat('U', {d.text('l_orderkey')}) AS unit_id,
       CASE WHEN l_quantity <= 45 THEN NULL WHEN l_tax < 0.03 THEN 'polarity_switching' WHEN l_tax < 0.05 THEN 'shared_content'
            ELSE 'no_signal' END AS code
FROM {d.table('lineitem')}"""


@shape("child")
def child(d: Dialect) -> str:
    """Children of a unit and the members they name; rows without a child name a member only."""
    return f"""
SELECT concat('U', {d.text('l_orderkey')}) AS unit_id, CASE WHEN l_tax >= 0.05 THEN NULL WHEN l_quantity > 25 THEN 'pos' ELSE 'neg' END AS child_key,
       CASE WHEN l_quantity > 25 THEN 'positive' ELSE 'negative' END AS ion_mode,
       CASE WHEN l_quantity > 25 THEN 'DDA' ELSE 'DIA' END AS acquisition_mode,
       concat('run', {d.text('l_suppkey')}, '/f', {d.text('l_partkey')},
              CASE WHEN l_quantity > 25 THEN '_pos' WHEN l_quantity > 10 THEN '_neg_C18_DIA' ELSE '' END,
              CASE WHEN l_linestatus = 'O' THEN '.raw' ELSE '.mzXML' END) AS member_path
FROM {d.table('lineitem')}"""


@shape("share")
def share(d: Dialect) -> str:
    """Files two units declare to share: order k with k+1, by part."""
    return f"""
SELECT DISTINCT concat('U', {d.text('l_orderkey')}) AS unit_id,
       concat('U', {d.text("CASE WHEN l_linestatus = 'O' THEN l_orderkey + 1 ELSE l_orderkey - 1 END")}) AS other_unit_id,
       concat('set/', p_name, '.raw') AS member_path
FROM {d.table('lineitem')} JOIN {d.table('part')} ON l_partkey = p_partkey"""


@shape("transition")
def transition(d: Dialect) -> str:
    """The event log as state transitions of units; the sequence is the event id."""
    return f"""
SELECT event_id AS seq, concat('u', {d.text('user_id')}) AS unit_key, user_id, {d.us('ts')} AS at_us,
       event_type AS to_state, value, {d.kprop()} AS k
FROM {d.table('events')}"""


@shape("attempt")
def attempt(d: Dialect) -> str:
    """The event log as attempts: the repository is the last digit of the user, the group the user."""
    return f"""
SELECT event_id AS attempt_id, concat('u', {d.text('user_id')}) AS unit_key,
       concat('r', {d.text('user_id % 5')}) AS repository, concat('g', {d.text('user_id')}) AS group_id,
       CASE WHEN event_type = 'click' THEN 'download_start' ELSE 'download' END AS step,
       CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'fault'
            WHEN 'view' THEN 'busy' ELSE 'interrupted' END AS outcome,
       CASE WHEN {d.kprop()} < 50 THEN 1 ELSE 0 END AS network,
       {d.us('ts')} AS started_us, {d.us('ts')} + cast(floor(value * 1000000 + 0.5) AS bigint) * 60 AS ended_us,
       {d.kprop()} AS k, cast(floor(value * 100 + 0.5) AS bigint) AS bytes
FROM {d.table('events')}"""


@shape("candidate")
def candidate(d: Dialect) -> str:
    """Annotation candidates: the feature is the order, the annotator the return flag."""
    return f"""
SELECT l_orderkey AS feature, l_returnflag AS annotator_id, cast(l_linenumber AS int) AS candidate_rank,
       l_suppkey * 100000 + l_partkey AS position,
       concat('KEY', lpad({d.text(d.div('l_partkey', '20'))}, 11, '0'), '-', {d.text('l_suppkey')}) AS structure_key,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_reference_matched,
       CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS is_representative
FROM {d.table('lineitem')}"""


@shape("doc")
def doc(d: Dialect) -> str:
    """Documents as files: the folder is the source, the checksum the digest of the text."""
    return f"""
SELECT doc_id, text, lang, source, n_chars, concat(source, '/d', {d.text('doc_id')}, '.raw') AS path, md5(text) AS digest
FROM {d.table('documents')}"""
