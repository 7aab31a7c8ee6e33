SELECT DISTINCT term FROM conflicts
