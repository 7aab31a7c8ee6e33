"""Sources and stores: sectioned report files, stored tables, relations derived from the test tables."""
