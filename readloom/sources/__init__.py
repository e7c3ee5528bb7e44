"""Sources and sinks: FASTQ, sample discovery, index maps, exporters."""
