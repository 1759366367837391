"""A view of synthetic bills over `documents`, in SQL that Spark and DuckDB both accept.

The texts hold every form that the extractors distinguish, chosen by remainders of doc_id:
headers, scanned headers and none, direct ids, dates in and out of the calendar, committees,
presenters and cosponsors, references, and numbered lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SQL = r"""
with base as (
  select doc_id, text, 121 + doc_id % 12 as sess,
    case (121 + doc_id % 12) % 10 when 1 then 'st' when 2 then 'nd' when 3 then 'rd' else 'th' end as sfx,
    case when doc_id % 20 < 17 then 'LD' when doc_id % 20 = 17 then 'SP' when doc_id % 20 = 18 then 'HP' else 'HO' end as kind,
    case doc_id % 6 when 0 then '' when 1 then '' when 2 then '-CA_A_H0266' when 3 then '-SA_B_S12'
      when 4 then '-CA_A-HA_A_H5' else '-XA_A_SA_A_S337' end as amendment,
    case doc_id % 5 when 0 then 'SMITH' when 1 then 'O''BRIEN' when 2 then 'BEEBE- CENTER' when 3 then 'VAN BUREN' else 'President JACKSON' end as person,
    lpad(cast(doc_id % 10000 as varchar(20)), 4, '0') as num
  from documents where text is not null
), parts as (
  select *,
    case when doc_id % 31 = 0 then concat('misc-', cast(doc_id as varchar(20))) else concat(cast(sess as varchar(20)), '-', kind, '-', num, amendment) end as filename,
    concat('STATE LEGISLATURE ', {NL}, 'LAW AND LEGISLATIVE DIGITAL LIBRARY ', {NL}, 'Reproduced from paper', {NL}) as preamble,
    case doc_id % 7
      when 0 then concat(cast(sess as varchar(20)), sfx, ' MAINE LEGISLATURE', {NL}, 'Legislative Document', {NL}, 'No. ', cast(doc_id % 9000 + 100 as varchar(20)))
      when 1 then concat('7 ', cast(sess as varchar(20)), upper(sfx), ' LEGISLATURE', {NL}, '9 SECOND REGULAR SESSION', {NL}, 'Document No. ', cast(doc_id % 9000 + 100 as varchar(20)))
      when 2 then concat('Bill ', cast(sess as varchar(20)), '-LD-', num)
      when 3 then concat('Bill ', cast(sess as varchar(20)), '-LD-', substring(num, 2, 3))
      when 4 then concat(cast(sess as varchar(20)), sfx, ' LEGISLATURE', {NL}, cast(sess as varchar(20)), '-LD-', num)
      when 5 then concat('For the ', cast(sess as varchar(20)), sfx, ' Maine session, No 77')
      else 'No header of any kind' end as head,
    case doc_id % 6
      when 0 then concat('House of Representatives, March ', cast(doc_id % 33 as varchar(20)), ', 2024')
      when 1 then concat('In Senate, April ', cast(doc_id % 35 as varchar(20)), ' 2023')
      when 2 then 'Feb 10, 2025'
      when 3 then 'House of Representatives, June 31, 2023 In House, Jul 4, 2022'
      when 4 then 'Received by the clerk'
      else 'In Senate, January 0, 0000' end as day,
    case doc_id % 5
      when 0 then concat('An Act to ', substring(text, 1, 20))
      when 1 then concat('Resolve, Regarding ', substring(text, 1, 15))
      when 2 then concat('COMMITTEE AMENDMENT "A" to H.P. 970, "An Act to Fund ', substring(text, 1, 9), '"')
      when 3 then '   ''An Act Resolved by Nobody'''
      else 'A Bill without either' end as name,
    case doc_id % 7
      when 0 then concat('Reference to the Committee on Judiciary suggested and ordered ', {NL}, 'printed.')
      when 1 then 'Reference to the Committee on Energy, Utilities and Technology.'
      when 2 then 'Referred to Committee on Education and Cultural Affairs.'
      when 3 then 'Assigned to Health & Human Services printed'
      when 4 then concat('Reference to the Committee on  Inland', {NL}, ' Fisheries   and Wildlife ordered printed')
      when 5 then 'The Committee on Labor referred it'
      else 'No panel' end as panel,
    case doc_id % 9
      when 0 then concat('Presented by Senator ', person, ' of York.')
      when 1 then concat('Introduced by Representative ', person, {NL}, 'Cosponsored by Senator JONES')
      when 2 then concat('Presented by Representative ', person, ' of Cumberland ', {NL}, 'Cosponsored by Senator JONES of York and Representative BROWN of Penobscot')
      when 3 then concat('Presented by President ', person, ' of Aroostook. Cosponsored by Senator LI of York, the Town of Hope, Representative BROWN of Bath')
      when 4 then 'Presented by Representative President JACKSON of Aroostook'
      when 5 then concat('Presented by Speaker ', person, ' of Bath', {NL}, 'Cosponsored by Representatives: MASON of Lisbon, Representative: SAYRE')
      when 6 then concat('Cosponsored by Representative ', person, ', Senator JONES, Senator JONES Be it enacted by the People')
      when 7 then 'Presented by Senator JEAN-PAUL SMITH and others'
      else 'By request' end as people,
    case doc_id % 5
      when 0 then concat('12 MRSA §13106-A is amended.', {NL}, 'See Title 20-A, Section 101 and Title 20-A, § 101.')
      when 1 then '5 MRSA §12004-G and 35-A MRSA §4002 and 5 MRSA §12004-G'
      when 2 then 'Title 5, Section 10'
      when 3 then 'Title 5, section 10'
      else '' end as refs
  from base
)
select doc_id, filename, concat(case when doc_id % 4 = 3 then '' else preamble end, head, {NL}, day, {NL}, name, {NL}, panel, {NL}, people, {NL},
  'Page 1 - 131LR(01)', {NL}, '    1', {NL}, '   5 Be it enacted by the People', {NL}, '42', {NL}, 'STATE OF MAINE', {NL}, {NL}, refs, {NL}, 'HOUSE OF REPRESENTATIVES', {NL}, '1515', {NL}, 'Page 12', {NL}, text) as raw_text
from parts
"""

FOR_SPARK = _SQL.replace("{NL}", r"'\n'")
FOR_DUCKDB = _SQL.replace("{NL}", "chr(10)")


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, filename and raw_text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spark.sql(FOR_SPARK.replace("from documents ", "from {docs} "), docs=docs)
