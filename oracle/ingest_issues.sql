SELECT term || '.csv' AS file, unnest(['row_without_header', 'short_row']) AS rule, CAST(1 AS BIGINT) AS records FROM ends
