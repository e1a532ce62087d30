"""Fixed schemas of the feeds and of the stored tables that are read without inference."""

from __future__ import annotations

RAW_CRASH = "uuid string, raw map<string,string>, submitted_timestamp timestamp, " \
            "legacy_processing int, dump string"
FORM = "uuid string, form map<string,string>, received timestamp, dump string"

RAW_ADU = "adu_count bigint, date timestamp, product_name string, product_os_platform string, " \
          "product_os_version string, product_version string, build string, " \
          "build_channel string, product_guid string"
BUGS = "bug_id bigint, bug_status string, resolution string, short_desc string, " \
       "cf_crash_signature string"
MODULES = "filename string, debug_file string, debug_id string, module_version string, " \
          "product string, version string, os_name string, reason string"
RELEASES = "product_name string, version string, platform string, build_id bigint, " \
           "build_type string, beta_number int, repository string"
REPORTS = ("id bigint, client_crash_date timestamp, date_processed timestamp, uuid string, "
           "product string, version string, build string, signature string, url string, "
           "install_age int, last_crash int, uptime int, cpu_name string, cpu_info string, "
           "reason string, address string, os_name string, os_version string, email string, "
           "user_id string, started_datetime timestamp, completed_datetime timestamp, "
           "success boolean, truncated boolean, processor_notes string, user_comments string, "
           "app_notes string, distributor string, distributor_version string, "
           "topmost_filenames string, addons_checked boolean, flash_version string, "
           "hangid string, process_type string, release_channel string, productid string")

#: Lookup tables of the bulk load, by name.
LOOKUPS = {
    "daily_crash_codes": "crash_code string, crash_type string",
    "os_names": "os_name string, os_short_name string",
    "os_name_matches": "os_name string, match_string string",
    "process_types": "process_type string",
    "products": "product_name string, sort int, rapid_release_version string, release_name string",
    "release_channels": "release_channel string, sort int",
    "product_release_channels": "product_name string, release_channel string, "
                                "throttle decimal(30,20)",
    "release_channel_matches": "release_channel string, match_string string",
    "uptime_levels": "uptime_level int, uptime_string string, min_uptime string, "
                     "max_uptime string",
    "windows_versions": "windows_version_name string, major_version int, minor_version int",
    "os_versions": "os_version_id int, os_name string, major_version int, minor_version int, "
                   "os_version_string string",
    "product_productid_map": "product_name string, productid string, rewrite string, "
                             "version_began string, version_ended string",
    "release_repositories": "repository string",
    "raw_adu": RAW_ADU,
    "releases_raw": RELEASES,
    "reports": REPORTS,
}

# The crash types, with the browser side of hangs left out of totals.
CRASH_TYPES = (
    ("Browser", "crash", "browser", False, "C", True),
    ("OOP Plugin", "oop", "plugin", False, "P", True),
    ("Hang Browser", "hang-b", "plugin", True, "c", False),
    ("Hang Plugin", "hang-p", "browser", True, "p", True),
    ("Content", "content", "content", False, "T", True),
)
CRASH_TYPE_SCHEMA = "crash_type string, crash_type_short string, process_type string, " \
                    "has_hang_id boolean, old_code string, include_agg boolean"

# Windows releases by version number.
WINDOWS_VERSIONS = (
    ("Windows NT", 3, 5), ("Windows NT", 4, 0), ("Windows 98", 4, 1), ("Windows Me", 4, 9),
    ("Windows 2000", 5, 0), ("Windows XP", 5, 1), ("Windows Vista", 6, 0), ("Windows 7", 6, 1),
)
WINDOWS_SCHEMA = "windows_version_name string, major_version int, minor_version int"

# Uptime buckets in seconds; the last ends after a year.
UPTIME_LEVELS = (
    (1, "< 1 min", 0, 60), (2, "1-5 min", 60, 300), (3, "5-15 min", 300, 900),
    (4, "15-60 min", 900, 3600), (5, "> 1 hour", 3600, 31557600),
)
UPTIME_SCHEMA = "uptime_level int, uptime_string string, min_uptime int, max_uptime int"

# Name patterns and short names of operating systems.
OS_NAME_MATCHES = (("Windows", "Windows%"), ("Mac OS X", "Mac%"), ("Linux", "Linux%"))
OS_NAMES = (("Windows", "win"), ("Mac OS X", "mac"), ("Linux", "lin"))
CHANNEL_MATCHES = (("Release", "release"), ("Release", "default"), ("Beta", "beta"),
                   ("Aurora", "aurora"), ("Nightly", "nightly%"))
RELEASE_CHANNELS = (("Nightly", 1), ("Aurora", 2), ("Beta", 3), ("Release", 4), ("ESR", 5))
