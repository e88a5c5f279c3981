"""matchlens: win rates and player activity from team-match records, on Spark DataFrames."""
