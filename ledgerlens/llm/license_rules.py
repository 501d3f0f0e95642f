"""The signature rules of the licence scan, in order.

One rule a line: ``label ; priority ; keywords ; pattern``. A pattern is a
regular expression over the normalised text: lower-case words (letters,
digits, non-ASCII characters) with one blank between them, so "GPL-3.0" reads
"gpl 3 0". Words in a pattern are whole words. A rule is only tried on texts
that hold one of its keywords (``a | b``), so every string that its pattern
matches must. A higher priority number wins where detections overlap:
full grants and SPDX tags (4) over named versions (3), names (2), hints (1).
"""

BASE_PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

RULES = r"""
mit ; 4 ; spdx ; spdx license identifier mit
mit ; 4 ; free of charge ; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit ; 3 ; mit ; (licensed|released|distributed|available) under (the )?(terms of )?(the )?mit( expat)? licen[sc]e
mit ; 3 ; mit ; the mit licen[sc]e( mit)?
mit ; 2 ; mit | expat ; (mit|expat) licen[sc]e
mit ; 2 ; opensource ; opensource org licenses mit( license)?( php)?
mit-0 ; 4 ; spdx ; spdx license identifier mit 0
mit-0 ; 3 ; mit ; mit no attribution( license)?
mit-0 ; 3 ; mit 0 ; mit 0 licen[sc]e
x11 ; 4 ; spdx ; spdx license identifier x11
x11 ; 3 ; x11 ; (the )?x11 licen[sc]e
x11 ; 3 ; x consortium ; except as contained in this notice the name of the x consortium shall not be used in advertising
isc ; 4 ; spdx ; spdx license identifier isc
isc ; 4 ; with or without fee ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc ; 3 ; isc ; (the )?isc licen[sc]e
0bsd ; 4 ; spdx ; spdx license identifier 0bsd
0bsd ; 3 ; zero clause ; (bsd )?zero clause (bsd )?licen[sc]e
apache-2.0 ; 4 ; spdx ; spdx license identifier apache 2 0
apache-2.0 ; 4 ; apache ; licensed under the apache license version 2 0( the license)?
apache-2.0 ; 4 ; apache ; apache license version 2 0 january 2004
apache-2.0 ; 3 ; apache ; apache (software )?licen[sc]e (v|ver |version )?2( 0)?
apache-2.0 ; 3 ; apache | asl ; (apache|asl) (v)?2( 0)? licen[sc]e
apache-2.0 ; 3 ; apache ; www apache org licenses license 2 0
apache-2.0 ; 3 ; apache ; apache 2( 0)?
apache-1.1 ; 4 ; spdx ; spdx license identifier apache 1 1
apache-1.1 ; 3 ; apache ; apache (software )?licen[sc]e (v|version )?1 1
apache-1.0 ; 3 ; apache ; apache (software )?licen[sc]e (v|version )?1 0
apache ; 2 ; apache ; (the )?apache (software )?licen[sc]e
bsd-2-clause ; 4 ; spdx ; spdx license identifier bsd 2 clause
bsd-2-clause ; 3 ; bsd ; (2|two) clause bsd( licen[sc]e)?
bsd-2-clause ; 3 ; bsd | simplified ; (simplified|freebsd) (bsd )?licen[sc]e
bsd-2-clause ; 3 ; bsd ; bsd (2|two) clause( licen[sc]e)?
bsd-3-clause ; 4 ; spdx ; spdx license identifier bsd 3 clause
bsd-3-clause ; 4 ; endorse ; neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote products
bsd-3-clause ; 3 ; bsd ; (3|three) clause bsd( licen[sc]e)?
bsd-3-clause ; 3 ; bsd ; (new|modified|revised) bsd( licen[sc]e)?
bsd-3-clause ; 3 ; bsd ; bsd (3|three) clause( licen[sc]e)?
bsd-4-clause ; 4 ; spdx ; spdx license identifier bsd 4 clause
bsd-4-clause ; 4 ; advertising ; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4-clause ; 3 ; bsd ; (4|four) clause bsd( licen[sc]e)?
bsd-4-clause ; 3 ; bsd ; (original|old) bsd licen[sc]e
bsd ; 3 ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted
bsd ; 2 ; bsd ; (licensed|released|distributed) under (the |a )?bsd( style| like)?( licen[sc]e)?
bsd ; 2 ; bsd ; (the |a )?bsd( style| like)? licen[sc]e
gpl-1.0 ; 4 ; spdx ; spdx license identifier gpl 1 0( only| or later)?
gpl-1.0 ; 3 ; general public ; gnu general public licen[sc]e (v|version )1( 0)?
gpl-2.0-only ; 4 ; spdx ; spdx license identifier gpl 2 0( only)?
gpl-2.0-or-later ; 4 ; spdx ; spdx license identifier gpl 2 0 or later
gpl-2.0-or-later ; 4 ; general public ; general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0-only ; 3 ; general public ; gnu general public licen[sc]e (v|version )2( 0)?( only| june 1991)?
gpl-2.0-or-later ; 3 ; general public ; gnu general public licen[sc]e (v|version )2( 0)? or (any )?later
gpl-2.0-only ; 3 ; gpl ; (gnu )?gpl ?(v|version )?2( 0)?( only)?
gpl-2.0-only ; 3 ; gplv2 ; (gnu )?gplv2( 0)?
gpl-2.0-or-later ; 3 ; gpl ; (gnu )?gpl ?(v|version )?2( 0)? or (any )?later
gpl-3.0-only ; 4 ; spdx ; spdx license identifier gpl 3 0( only)?
gpl-3.0-or-later ; 4 ; spdx ; spdx license identifier gpl 3 0 or later
gpl-3.0-or-later ; 4 ; general public ; general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0-only ; 3 ; general public ; gnu general public licen[sc]e (v|version )3( 0)?( only| 29 june 2007)?
gpl-3.0-or-later ; 3 ; general public ; gnu general public licen[sc]e (v|version )3( 0)? or (any )?later
gpl-3.0-only ; 3 ; gpl ; (gnu )?gpl ?(v|version )?3( 0)?( only)?
gpl-3.0-only ; 3 ; gplv3 ; (gnu )?gplv3( 0)?
gpl-3.0-or-later ; 3 ; gpl ; (gnu )?gpl ?(v|version )?3( 0)? or (any )?later
gpl ; 2 ; general public ; (gnu )?general public licen[sc]e
gpl ; 2 ; gpl ; (under|the) (terms of )?(the )?(gnu )?gpl
gpl ; 2 ; gpl ; gpl licen[sc]ed?
gpl ; 1 ; gnu.org ; www gnu org licenses( gpl( html| txt)?)?
gpl-classpath-exception ; 4 ; classpath ; (gpl|general public license) .{0,60}?with (the )?classpath exception
gpl-classpath-exception ; 3 ; classpath ; classpath exception( 2 0)?
gpl-font-exception ; 3 ; font exception ; (gnu |gpl )?font exception( 2 0)?
gpl-linking-exception ; 3 ; linking exception ; (gpl |gnu )?linking exception
gcc-runtime-exception ; 3 ; runtime library exception ; gcc runtime library exception
llvm-exception ; 3 ; llvm ; (apache 2 0 )?with llvm exceptions?
lgpl-2.0 ; 4 ; spdx ; spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.0 ; 3 ; library general ; gnu library general public licen[sc]e( (v|version )?2( 0)?)?
lgpl-2.1 ; 4 ; spdx ; spdx license identifier lgpl 2 1( only| or later)?
lgpl-2.1 ; 4 ; lesser general ; lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-2.1 ; 3 ; lesser general ; gnu lesser general public licen[sc]e (v|version )?2 1
lgpl-2.1 ; 3 ; lgpl ; lgpl ?(v|version )?2 1
lgpl-2.1 ; 3 ; lgplv2 ; lgplv2( 1)?
lgpl-3.0 ; 4 ; spdx ; spdx license identifier lgpl 3 0( only| or later)?
lgpl-3.0 ; 3 ; lesser general ; gnu lesser general public licen[sc]e (v|version )?3( 0)?
lgpl-3.0 ; 3 ; lgpl ; lgpl ?(v|version )?3( 0)?
lgpl-3.0 ; 3 ; lgplv3 ; lgplv3( 0)?
lgpl ; 2 ; lesser general ; (gnu )?lesser general public licen[sc]e
lgpl ; 2 ; lgpl ; (gnu )?lgpl( licen[sc]ed?)?
agpl-1.0 ; 3 ; affero ; affero general public licen[sc]e (v|version )?1( 0)?
agpl-3.0 ; 4 ; spdx ; spdx license identifier agpl 3 0( only| or later)?
agpl-3.0 ; 4 ; affero ; gnu affero general public license as published by the free software foundation
agpl-3.0 ; 3 ; affero ; (gnu )?affero general public licen[sc]e (v|version )?3( 0)?
agpl-3.0 ; 3 ; agpl ; agpl ?(v|version )?3( 0)?
agpl-3.0 ; 3 ; agplv3 ; agplv3( 0)?
agpl ; 2 ; affero ; (gnu )?affero general public licen[sc]e
agpl ; 2 ; agpl ; (gnu )?agpl( licen[sc]ed?)?
gfdl-1.1 ; 3 ; free documentation ; gnu free documentation licen[sc]e (v|version )?1 1
gfdl-1.2 ; 3 ; free documentation ; gnu free documentation licen[sc]e (v|version )?1 2
gfdl-1.3 ; 4 ; spdx ; spdx license identifier gfdl 1 3( only| or later)?
gfdl-1.3 ; 3 ; free documentation ; gnu free documentation licen[sc]e (v|version )?1 3
gfdl ; 2 ; free documentation ; (gnu )?free documentation licen[sc]e
gfdl ; 2 ; gfdl ; (the )?gfdl
mpl-1.0 ; 3 ; mozilla ; mozilla public licen[sc]e (v|version )?1 0
mpl-1.1 ; 4 ; spdx ; spdx license identifier mpl 1 1
mpl-1.1 ; 3 ; mozilla ; mozilla public licen[sc]e (v|version )?1 1
mpl-1.1 ; 3 ; mpl ; mpl ?(v)?1 1
mpl-2.0 ; 4 ; spdx ; spdx license identifier mpl 2 0( no copyleft exception)?
mpl-2.0 ; 4 ; mozilla ; this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 ; 3 ; mozilla ; mozilla public licen[sc]e (v|v |version )?2( 0)?
mpl-2.0 ; 3 ; mpl ; mpl ?(v)?2( 0)?
mpl ; 2 ; mozilla ; mozilla public licen[sc]e
epl-1.0 ; 4 ; spdx ; spdx license identifier epl 1 0
epl-1.0 ; 3 ; eclipse ; eclipse public licen[sc]e (v|v |version )?1( 0)?
epl-2.0 ; 4 ; spdx ; spdx license identifier epl 2 0
epl-2.0 ; 3 ; eclipse ; eclipse public licen[sc]e (v|v |version )?2( 0)?
epl ; 2 ; eclipse ; eclipse public licen[sc]e
edl-1.0 ; 3 ; eclipse ; eclipse distribution licen[sc]e( (v|v |version )?1( 0)?)?
cddl-1.0 ; 4 ; spdx ; spdx license identifier cddl 1 0
cddl-1.0 ; 3 ; common development ; common development and distribution licen[sc]e( cddl)? (v|version )?1 0
cddl-1.1 ; 3 ; common development ; common development and distribution licen[sc]e( cddl)? (v|version )?1 1
cddl ; 2 ; common development ; common development and distribution licen[sc]e
cddl ; 2 ; cddl ; cddl( licen[sc]e)?
cpl-1.0 ; 3 ; common public ; common public licen[sc]e( (v|version )?1 0)?
cpal-1.0 ; 3 ; common public attribution ; common public attribution licen[sc]e( (v|version )?1 0)?
ipl-1.0 ; 3 ; ibm public ; ibm public licen[sc]e( (v|version )?1 0)?
artistic-1.0 ; 4 ; spdx ; spdx license identifier artistic 1 0( perl| cl8)?
artistic-1.0 ; 3 ; artistic ; artistic licen[sc]e (v|version )?1 0
artistic-2.0 ; 4 ; spdx ; spdx license identifier artistic 2 0
artistic-2.0 ; 3 ; artistic ; artistic licen[sc]e (v|version )?2 0
artistic ; 2 ; artistic ; (perl |the )?artistic licen[sc]e
perl ; 2 ; perl ; under the same terms as perl( itself)?
psf-2.0 ; 4 ; spdx ; spdx license identifier (psf|python) 2 0( 1)?
psf-2.0 ; 3 ; python software ; python software foundation licen[sc]e( (v|version )?2)?
ruby ; 3 ; ruby ; under the (terms of the )?ruby licen[sc]e
ruby ; 2 ; ruby ; ruby licen[sc]e
php-3.01 ; 3 ; php ; php licen[sc]e (v|version )?3 0?1
php ; 2 ; php ; (the )?php licen[sc]e
zlib ; 4 ; spdx ; spdx license identifier zlib
zlib ; 4 ; origin of this software ; the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib ; 3 ; zlib ; (the )?zlib( libpng)? licen[sc]e
libpng ; 3 ; png ; (the )?(png|libpng) (reference library )?licen[sc]e
boost-1.0 ; 4 ; spdx ; spdx license identifier bsl 1 0
boost-1.0 ; 4 ; boost ; (distributed|licensed) under the boost software license version 1 0
boost-1.0 ; 3 ; boost ; boost software licen[sc]e( (v|version )?1 0)?
unlicense ; 4 ; spdx ; spdx license identifier unlicense
unlicense ; 4 ; public domain ; this is free and unencumbered software released into the public domain
unlicense ; 3 ; unlicense ; (the )?unlicense
wtfpl ; 4 ; spdx ; spdx license identifier wtfpl
wtfpl ; 3 ; what the ; do what the fuck you want to public licen[sc]e
wtfpl ; 3 ; wtfpl ; (the )?wtfpl
beerware ; 3 ; beer ; (the )?beer ?ware licen[sc]e
json ; 4 ; good ; the software shall be used for good not evil
json ; 2 ; json ; (the )?json licen[sc]e
cc0-1.0 ; 4 ; spdx ; spdx license identifier cc0 1 0
cc0-1.0 ; 4 ; cc0 ; cc0 1 0 universal( public domain dedication)?
cc0-1.0 ; 3 ; creative commons ; creative commons (cc0|zero)( licen[sc]e| 1 0)?
cc0-1.0 ; 3 ; publicdomain ; creativecommons org publicdomain zero 1 0
cc0 ; 2 ; cc0 ; cc0( waiver| licen[sc]e)?
cc-pdm ; 3 ; public domain mark ; (creative commons )?public domain mark( 1 0)?
cc-by-1.0 ; 3 ; cc ; cc by 1 0
cc-by-2.0 ; 4 ; spdx ; spdx license identifier cc by 2 0
cc-by-2.0 ; 3 ; cc ; cc by 2 0
cc-by-2.5 ; 3 ; cc ; cc by 2 5
cc-by-3.0 ; 4 ; spdx ; spdx license identifier cc by 3 0
cc-by-3.0 ; 3 ; cc ; cc by 3 0
cc-by-3.0 ; 3 ; attribution ; (creative commons )?attribution 3 0( unported| international)?( licen[sc]e)?
cc-by-4.0 ; 4 ; spdx ; spdx license identifier cc by 4 0
cc-by-4.0 ; 3 ; cc ; cc by 4 0
cc-by-4.0 ; 3 ; attribution ; (creative commons )?attribution 4 0( international)?( public)?( licen[sc]e)?
cc-by-4.0 ; 3 ; creativecommons ; creativecommons org licenses by 4 0
cc-by-3.0 ; 3 ; creativecommons ; creativecommons org licenses by 3 0
cc-by ; 2 ; creative commons ; creative commons attribution( licen[sc]e)?
cc-by ; 2 ; cc ; cc by( licen[sc]e)?
cc-by-sa-2.0 ; 3 ; cc ; cc by sa 2 0
cc-by-sa-2.5 ; 3 ; cc ; cc by sa 2 5
cc-by-sa-3.0 ; 4 ; spdx ; spdx license identifier cc by sa 3 0
cc-by-sa-3.0 ; 3 ; cc ; cc by sa 3 0
cc-by-sa-3.0 ; 3 ; creativecommons ; creativecommons org licenses by sa 3 0
cc-by-sa-4.0 ; 4 ; spdx ; spdx license identifier cc by sa 4 0
cc-by-sa-4.0 ; 3 ; cc ; cc by sa 4 0
cc-by-sa-4.0 ; 3 ; creativecommons ; creativecommons org licenses by sa 4 0
cc-by-sa-3.0 ; 3 ; share ; attribution share ?alike 3 0( unported| international)?( licen[sc]e)?
cc-by-sa-4.0 ; 3 ; share ; attribution share ?alike 4 0( international)?( licen[sc]e)?
cc-by-sa ; 3 ; cc ; cc by sa( licen[sc]e)?
cc-by-sa ; 2 ; share ; (creative commons )?attribution share ?alike( licen[sc]e)?
cc-by-nc-2.0 ; 3 ; cc ; cc by nc 2 0
cc-by-nc-3.0 ; 3 ; cc ; cc by nc 3 0
cc-by-nc-4.0 ; 4 ; spdx ; spdx license identifier cc by nc 4 0
cc-by-nc-4.0 ; 3 ; cc ; cc by nc 4 0
cc-by-nc-4.0 ; 3 ; creativecommons ; creativecommons org licenses by nc 4 0
cc-by-nc ; 3 ; cc ; cc by nc( licen[sc]e)?
cc-by-nc ; 2 ; commercial ; (creative commons )?attribution non ?commercial( licen[sc]e)?
cc-by-nd-3.0 ; 3 ; cc ; cc by nd 3 0
cc-by-nd-4.0 ; 4 ; spdx ; spdx license identifier cc by nd 4 0
cc-by-nd-4.0 ; 3 ; cc ; cc by nd 4 0
cc-by-nd-4.0 ; 3 ; creativecommons ; creativecommons org licenses by nd 4 0
cc-by-nd ; 3 ; cc ; cc by nd( licen[sc]e)?
cc-by-nd ; 2 ; deriv ; (creative commons )?attribution no ?deriv(s|atives)( works)?( licen[sc]e)?
cc-by-nc-sa-3.0 ; 3 ; cc ; cc by nc sa 3 0
cc-by-nc-sa-4.0 ; 4 ; spdx ; spdx license identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 ; 3 ; cc ; cc by nc sa 4 0
cc-by-nc-sa-4.0 ; 3 ; creativecommons ; creativecommons org licenses by nc sa 4 0
cc-by-nc-sa ; 3 ; cc ; cc by nc sa( licen[sc]e)?
cc-by-nc-sa ; 3 ; commercial ; attribution non ?commercial share ?alike( [1-4] 0)?( international| unported)?( licen[sc]e)?
cc-by-nc-nd-3.0 ; 3 ; cc ; cc by nc nd 3 0
cc-by-nc-nd-4.0 ; 4 ; spdx ; spdx license identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 ; 3 ; cc ; cc by nc nd 4 0
cc-by-nc-nd-4.0 ; 3 ; creativecommons ; creativecommons org licenses by nc nd 4 0
cc-by-nc-nd ; 3 ; cc ; cc by nc nd( licen[sc]e)?
cc-by-nc-nd ; 3 ; commercial ; attribution non ?commercial no ?deriv(s|atives)( [1-4] 0)?( international| unported)?( licen[sc]e)?
creative-commons ; 1 ; creative commons ; (a |the )?creative commons licen[sc]e
creative-commons ; 1 ; some rights reserved ; some rights reserved
odbl-1.0 ; 4 ; spdx ; spdx license identifier odbl 1 0
odbl-1.0 ; 3 ; open database ; (odc )?open database licen[sc]e( odbl)?( (v|version )?1 0)?
odc-by-1.0 ; 3 ; open data commons ; open data commons attribution licen[sc]e( (v|version )?1 0)?
pddl-1.0 ; 3 ; public domain dedication ; (odc |open data commons )?public domain dedication and licen[sc]e( (v|version )?1 0)?
ogl-uk-3.0 ; 3 ; open government ; open government licen[sc]e( (v|version )?3 0)?
cdla-permissive ; 3 ; community data ; community data licen[sc]e agreement permissive( (v|version )?[12] 0)?
cdla-sharing ; 3 ; community data ; community data licen[sc]e agreement sharing( (v|version )?1 0)?
etalab-2.0 ; 3 ; etalab | licence ouverte ; (licence ouverte |etalab )+(2 0|open licen[sc]e)
dl-de-by-2.0 ; 3 ; datenlizenz ; datenlizenz deutschland namensnennung( version)? 2 0
ofl-1.1 ; 4 ; spdx ; spdx license identifier ofl 1 1
ofl-1.1 ; 4 ; font ; this font software is licensed under the sil open font license version 1 1
ofl-1.1 ; 3 ; open font ; (sil )?open font licen[sc]e( (v|version )?1 1)?
bitstream-vera ; 3 ; bitstream ; bitstream vera (fonts )?(copyright|licen[sc]e)
eupl-1.1 ; 3 ; european union ; european union public licen[sc]e (v|version )?1 1
eupl-1.2 ; 4 ; spdx ; spdx license identifier eupl 1 2
eupl-1.2 ; 3 ; european union ; european union public licen[sc]e (v|version )?1 2
eupl ; 2 ; european union ; european union public licen[sc]e
cecill-2.1 ; 3 ; cecill ; cecill (licen[sc]e )?(v|version )?2 1
cecill ; 2 ; cecill ; (licence )?cecill( [bc])?( licen[sc]e)?
ms-pl ; 4 ; spdx ; spdx license identifier ms pl
ms-pl ; 3 ; microsoft public ; microsoft public licen[sc]e( ms pl)?
ms-rl ; 3 ; microsoft reciprocal ; microsoft reciprocal licen[sc]e( ms rl)?
upl-1.0 ; 3 ; universal permissive ; universal permissive licen[sc]e( (v|version )?1 0)?
afl-3.0 ; 3 ; academic free ; academic free licen[sc]e( (v|version )?[123] [01])?
osl-3.0 ; 3 ; open software ; open software licen[sc]e( (v|version )?[123] [01])?
ecl-2.0 ; 3 ; educational community ; educational community licen[sc]e( (v|version )?2 0)?
ncsa ; 3 ; ncsa ; (university of illinois )?ncsa open source licen[sc]e
postgresql ; 3 ; postgresql ; (the )?postgresql licen[sc]e
openssl ; 3 ; openssl ; (the )?(openssl|openssl ssleay) licen[sc]e
w3c ; 3 ; w3c ; w3c software (notice and )?licen[sc]e
unicode-dfs ; 3 ; unicode ; unicode licen[sc]e agreement( data files and software)?
icu ; 3 ; icu ; icu licen[sc]e( icu 1 8 1 and later)?
vim ; 3 ; vim ; (the )?vim licen[sc]e
tcl ; 3 ; tcl ; tcl tk licen[sc]e
sleepycat ; 3 ; sleepycat ; sleepycat( software)? licen[sc]e
lppl-1.3c ; 3 ; latex ; latex project public licen[sc]e( (v|version )?1 3c?)?
qpl-1.0 ; 3 ; q public ; q public licen[sc]e( (v|version )?1 0)?
nasa-1.3 ; 3 ; nasa ; nasa open source agreement( (v|version )?1 3)?
apsl-2.0 ; 3 ; apple public ; apple public source licen[sc]e( (v|version )?[12] [0-2])?
rpl-1.5 ; 3 ; reciprocal public ; reciprocal public licen[sc]e( (v|version )?1 [15])?
sspl-1.0 ; 3 ; server side ; server side public licen[sc]e( (v|version )?1)?
busl-1.1 ; 3 ; business source ; business source licen[sc]e( (v|version )?1 1)?
elastic-2.0 ; 3 ; elastic ; elastic licen[sc]e( (v|version )?2( 0)?)?
commons-clause ; 3 ; commons clause ; commons clause( license)? condition( (v|version )?1 0)?
polyform ; 3 ; polyform ; polyform (noncommercial|small business|shield|strict|perimeter|free trial) licen[sc]e
openrail ; 3 ; openrail ; (bigscience |creativeml |big ?code )?openrail( m)?( licen[sc]e)?
rail ; 3 ; responsible ai ; responsible ai licen[sc]e
free-art-1.3 ; 3 ; free art ; free art licen[sc]e( 1 3)?
hippocratic ; 3 ; hippocratic ; hippocratic licen[sc]e( (v|version )?[123] [01])?
mulan-psl-2.0 ; 3 ; mulan ; mulan (psl|permissive software licen[sc]e)( v?2)?
blueoak-1.0.0 ; 3 ; blue oak ; blue oak model licen[sc]e( 1 0 0)?
public-domain ; 2 ; public domain ; (released|dedicated|placed|put) (in|into|to) the public domain
public-domain ; 1 ; public domain ; (is|are) (in )?(the )?public domain
proprietary ; 3 ; proprietary ; proprietary and confidential
proprietary ; 2 ; proprietary ; (this|the) (software|code|document|material) is proprietary
proprietary ; 2 ; unauthorized | unauthorised ; unauthori[sz]ed (copying|reproduction|distribution|use) of this .{1,60}? is (strictly )?prohibited
proprietary ; 2 ; permission | consent ; (may|must) not be (reproduced|copied|distributed|republished) without (the )?(prior |express |written )+(permission|consent)
proprietary ; 2 ; licensed ; licensed materials property of
eula ; 2 ; end user ; end user licen[sc]e agreement
reserved ; 2 ; all rights reserved ; all rights reserved
reserved ; 1 ; alle rechte ; alle rechte vorbehalten
reserved ; 1 ; tous droits ; tous droits r\S+serv\S+s
reserved ; 1 ; derechos ; todos los derechos reservados
copyright ; 1 ; copyright ; copyright (c )?([12][0-9]{3})( [12][0-9]{3})?
copyright ; 1 ; copyrighted ; this (work|material|text|software) is copyrighted
disclaimer ; 1 ; warranty ; (the )?software is provided as is without warranty of any kind
disclaimer ; 1 ; warranties ; without warranties or conditions of any kind
spdx ; 1 ; spdx ; spdx license identifier
""".strip()
