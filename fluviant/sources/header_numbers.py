"""Regions and their header numbers, the leading digits of global ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Region number and header number, as the data sets define them.
HEADER_NUMBERS = {
    1020000010: 11, 1020011530: 12, 1020018110: 13, 1020021940: 14, 1020027430: 15, 1020034170: 16,
    1020035180: 17, 1020040190: 18, 2020000010: 21, 2020003440: 22, 2020018240: 23, 2020024230: 24,
    2020033490: 25, 2020041390: 26, 2020057170: 27, 2020065840: 28, 2020071190: 29, 3020000010: 31,
    3020003790: 32, 3020005240: 33, 3020008670: 34, 3020009320: 35, 3020024310: 36, 4020000010: 41,
    4020006940: 42, 4020015090: 43, 4020024190: 44, 4020034510: 45, 4020050210: 46, 4020050220: 47,
    4020050290: 48, 4020050470: 49, 5020000010: 51, 5020015660: 52, 5020037270: 53, 5020049720: 54,
    5020054880: 55, 5020055870: 56, 5020082270: 57, 6020000010: 61, 6020006540: 62, 6020008320: 63,
    6020014330: 64, 6020017370: 65, 6020021870: 66, 6020029280: 67, 7020000010: 71, 7020014250: 72,
    7020021430: 73, 7020024600: 74, 7020038340: 75, 7020046750: 76, 7020047840: 77, 7020065090: 78,
    8020000010: 81, 8020008900: 82, 8020010700: 83, 8020020760: 84, 8020022890: 85, 8020032840: 86,
    8020044560: 87, 9020000010: 91,
}


def header_numbers(spark: SparkSession) -> DataFrame:
    """``region_number`` (string, as in file names) and ``header`` (long); 62 rows at most."""
    return spark.createDataFrame([(str(r), h) for r, h in HEADER_NUMBERS.items()], "region_number string, header long")


def header_number(region_number: int | str) -> int:
    """The header number of one region; KeyError for an unknown one."""
    return HEADER_NUMBERS[int(region_number)]
