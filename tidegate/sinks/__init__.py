"""Writers. Data is written first, its marker after it."""
