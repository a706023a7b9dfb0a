"""SQL of the RFM queries, in the terms of the reference: averages as avg or total / count, rounded with round()."""

TX = """tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Transaction_ID, o_custkey AS CustomerID,
         CAST(o_orderdate AS DATE) AS Purchase_Date, CAST(o_totalprice AS DECIMAL(18,2)) AS GMV
  FROM orders)"""

CLEAN = """clean AS (SELECT * FROM tx WHERE GMV > 0 AND CustomerID <> 0)"""

TOTALS = """totals AS (
  SELECT CustomerID, max(Purchase_Date) AS Last_Purchase, count(Transaction_ID) AS Frequency,
         sum(GMV) AS Monetary
  FROM clean GROUP BY CustomerID)"""

BASE = """base AS (
  SELECT CustomerID,
         CAST(date_diff('day', Last_Purchase, (SELECT max(Last_Purchase) FROM totals) + 1) AS INTEGER) AS Recency,
         Frequency, Monetary,
         CAST(round(Monetary / Frequency) AS DOUBLE) AS AOV
  FROM totals)"""

SCORED = """scored AS (
  SELECT *, CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score
  FROM (SELECT *,
          CAST(6 - ntile(5) OVER (ORDER BY Recency, CustomerID) AS INTEGER) AS R_Score,
          CAST(ntile(5) OVER (ORDER BY Frequency, CustomerID) AS INTEGER) AS F_Score,
          CAST(ntile(5) OVER (ORDER BY Monetary, CustomerID) AS INTEGER) AS M_Score
        FROM base))"""

SEGMENTED = """segmented AS (
  SELECT *, CASE
      WHEN R_Score >= 4 AND FM_Score >= 4 THEN 'Champions'
      WHEN R_Score >= 3 AND FM_Score >= 4 THEN 'Loyal Customers'
      WHEN R_Score >= 4 AND FM_Score BETWEEN 2 AND 3 THEN 'Potential Loyalist'
      WHEN R_Score >= 4 AND FM_Score <= 1 THEN 'Recent Customers'
      WHEN R_Score = 3 AND FM_Score <= 1 THEN 'Promising'
      WHEN R_Score = 3 AND FM_Score BETWEEN 2 AND 3 THEN 'Need Attention'
      WHEN R_Score = 2 AND FM_Score BETWEEN 1 AND 2 THEN 'About to Sleep'
      WHEN R_Score = 2 AND FM_Score >= 3 THEN 'At Risk'
      WHEN R_Score = 1 AND FM_Score >= 4 THEN 'Can''t Lose Them'
      WHEN R_Score = 1 AND FM_Score BETWEEN 2 AND 3 THEN 'Hibernating'
      ELSE 'Lost' END AS Segment
  FROM (SELECT *, CAST(round((F_Score + M_Score) / 2.0) AS INTEGER) AS FM_Score FROM scored))"""

RFM_RESULT = """rfm AS (
  SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, AOV, RFM_Score, Segment
  FROM segmented)"""

RFM_CTES = [TX, CLEAN, TOTALS, BASE, SCORED, SEGMENTED, RFM_RESULT]


def with_ctes(ctes, select):
    return "WITH " + ",\n".join(ctes) + "\n" + select


SQL = {
    "rfm_clean": with_ctes([TX, CLEAN], """
SELECT Transaction_ID, CustomerID, strftime(Purchase_Date, '%Y-%m-%d') AS Purchase_Date,
       CAST(GMV AS DOUBLE) AS GMV FROM clean"""),
    **dict.fromkeys(("rfm_clean_audit", "rfm_run_audit"), with_ctes([TX], """
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE GMV > 0 AND CustomerID <> 0) AS rows_after,
       count(*) - count(*) FILTER (WHERE GMV > 0 AND CustomerID <> 0) AS rows_removed,
       count(DISTINCT CASE WHEN GMV > 0 AND CustomerID <> 0 THEN CustomerID END) AS customers
FROM tx""")),
    "rfm_base": with_ctes([TX, CLEAN, TOTALS, BASE], """
SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, AOV FROM base"""),
    "rfm_scores": with_ctes([TX, CLEAN, TOTALS, BASE, SCORED], """
SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, AOV,
       R_Score, F_Score, M_Score, RFM_Score FROM scored"""),
    **dict.fromkeys(("rfm_segments", "rfm_segments_audited", "rfm_from_csv", "rfm_appended_once"), with_ctes(RFM_CTES, "SELECT * FROM rfm")),
    "rfm_segment_counts": with_ctes(RFM_CTES, "SELECT Segment, count(*) AS count FROM rfm GROUP BY Segment"),
    "global_ntile": with_ctes([TX, CLEAN, TOTALS], """
SELECT CustomerID, CAST(Monetary AS DOUBLE) AS Monetary,
       CAST(ntile(7) OVER (ORDER BY Monetary, CustomerID) AS INTEGER) AS tile,
       CAST(ntile(7) OVER (ORDER BY Frequency, CustomerID) AS INTEGER) AS tile_frequency
FROM totals"""),
}
