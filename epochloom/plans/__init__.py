"""The daily metric jobs, the frames they share, and the series drawn from them."""
