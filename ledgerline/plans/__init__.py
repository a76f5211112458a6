"""Report plans: one function per report family, run as MT or ST."""
