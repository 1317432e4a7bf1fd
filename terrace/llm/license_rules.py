"""Hand-written licence signatures over normalised words.

The text they run on has lower-case words parted by one space, nothing else.
One rule a line: label ; priority ; keywords that must all occur ; expression.
Keywords are whole words that every match of the expression holds.
Priority 1 is a reference with version or an unmistakable sentence, 2 a name
without version, 3 a hint.  Order matters: of detections of equal rank over
the same words the earlier rule wins.  A trailing ``base`` marks the
contract's phrases, which are never suppressed.
"""

SIGNATURES = r"""
mit ; 1 ; mit license ; under the mit license ; base
apache-2 ; 1 ; apache version ; apache license version 2 ; base
cc-by-nc ; 1 ; cc nc ; cc by nc ; base
mit ; 1 ; spdx mit ; spdx license identifier mit
mit ; 1 ; permission charge software ; permission is hereby granted free of charge to any person obtaining a copy of this software
mit ; 2 ; mit ; mit licen[sc]ed?
mit ; 2 ; opensource mit ; opensource org licenses? mit
mit ; 2 ; expat ; expat licen[sc]e
mit-0 ; 1 ; mit attribution ; mit no attribution(?: license)?
mit-0 ; 1 ; spdx mit ; spdx license identifier mit 0
x11 ; 2 ; x11 ; x11 licen[sc]e
x11 ; 1 ; consortium ; except as contained in this notice the name of the x consortium
apache-1.0 ; 1 ; apache ; apache (?:software )?licen[sc]e version 1 0
apache-1.1 ; 1 ; apache ; apache (?:software )?licen[sc]e version 1 1
apache-2.0 ; 1 ; apache ; apache (?:software )?licen[sc]e (?:version |v )?2 0
apache-2.0 ; 1 ; apache licenses ; apache org licenses license 2 0
apache-2.0 ; 1 ; spdx apache ; spdx license identifier apache 2 0
apache-2.0 ; 1 ; asl ; asl (?:version |v )?2 0
apache ; 2 ; apache ; apache (?:software )?(?:foundation )?licen[sc]e
apache ; 3 ; apache ; apache licen[sc]ed
bsd-0 ; 1 ; 0bsd ; 0bsd
bsd-0 ; 1 ; zero clause bsd ; (?:bsd zero clause|zero clause bsd)(?: license)?
bsd-1 ; 1 ; clause bsd ; (?:bsd 1 clause|1 clause bsd)(?: license)?
bsd-2 ; 1 ; clause bsd ; (?:bsd (?:2|two) clause|(?:2|two) clause bsd)(?: license)?
bsd-2 ; 1 ; simplified bsd ; simplified bsd(?: license)?
bsd-2 ; 1 ; freebsd ; freebsd (?:documentation )?licen[sc]e
bsd-3 ; 1 ; clause bsd ; (?:bsd (?:3|three) clause|(?:3|three) clause bsd)(?: license)?
bsd-3 ; 1 ; bsd ; (?:new|modified|revised) bsd(?: license)?
bsd-3 ; 1 ; endorse promote ; neither the name of .{1,80}? may be used to endorse or promote products
bsd-4 ; 1 ; clause bsd ; (?:bsd (?:4|four) clause|(?:4|four) clause bsd)(?: license)?
bsd-4 ; 1 ; advertising acknowledgement ; all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd ; 2 ; bsd ; bsd (?:style )?licen[sc]ed?
bsd ; 2 ; redistribution binary ; redistribution and use in source and binary forms with or without modification
isc ; 2 ; isc ; isc licen[sc]e
isc ; 1 ; permission fee copy ; permission to use copy modify and or distribute this software for any purpose with or without fee
gpl-1.0 ; 1 ; gnu general ; gnu general public licen[sc]e version 1(?: 0)?
gpl-2.0 ; 1 ; gnu general ; gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )2(?: 0)?
gpl-2.0-or-later ; 1 ; gnu later ; gnu general public licen[sc]e .{0,80}?version 2(?: of the license)? or at your option any later version
gpl-3.0 ; 1 ; gnu general ; gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )3(?: 0)?
gpl-3.0-or-later ; 1 ; gnu later ; gnu general public licen[sc]e .{0,80}?version 3(?: of the license)? or at your option any later version
gpl-1.0 ; 1 ; gpl ; gpl (?:version |v )?1 0
gpl-2.0 ; 1 ; gpl ; gpl (?:version |v )?2(?: 0)?
gpl-2.0 ; 1 ; gplv2 ; gplv2
gpl-3.0 ; 1 ; gpl ; gpl (?:version |v )?3(?: 0)?
gpl-3.0 ; 1 ; gplv3 ; gplv3
gpl-2.0-only ; 1 ; gpl only ; gpl 2 0 only
gpl-2.0-or-later ; 1 ; gpl later ; gpl 2 0 or later
gpl-3.0-only ; 1 ; gpl only ; gpl 3 0 only
gpl-3.0-or-later ; 1 ; gpl later ; gpl 3 0 or later
gpl ; 2 ; gnu general ; gnu general public licen[sc]e
gpl ; 2 ; gpl ; (?:gnu )?gpl
gpl ; 3 ; copyleft ; copyleft
gpl-classpath ; 1 ; classpath exception ; (?:with )?(?:the )?classpath exception
gpl-linking ; 1 ; linking exception ; (?:with )?(?:a )?(?:static )?linking exception
lgpl-2.0 ; 1 ; gnu library ; gnu library general public licen[sc]e version 2(?: 0)?
lgpl-2.1 ; 1 ; gnu lesser ; gnu lesser general public licen[sc]e (?:version |v )2 1
lgpl-3.0 ; 1 ; gnu lesser ; gnu lesser general public licen[sc]e (?:version |v )3(?: 0)?
lgpl-2.0 ; 1 ; lgpl ; lgpl (?:version |v )?2 0
lgpl-2.1 ; 1 ; lgpl ; lgpl (?:version |v )?2 1
lgpl-2.1 ; 1 ; lgplv2 ; lgplv2(?: 1)?
lgpl-3.0 ; 1 ; lgpl ; lgpl (?:version |v )?3(?: 0)?
lgpl-3.0 ; 1 ; lgplv3 ; lgplv3
lgpl-2.1-or-later ; 1 ; lgpl later ; lgpl 2 1 or later
lgpl-3.0-or-later ; 1 ; lgpl later ; lgpl 3 0 or later
lgpl ; 2 ; gnu lesser ; gnu lesser general public licen[sc]e
lgpl ; 2 ; gnu library ; gnu library general public licen[sc]e
lgpl ; 2 ; lgpl ; (?:gnu )?lgpl
agpl-1.0 ; 1 ; affero ; affero general public licen[sc]e (?:version |v )?1(?: 0)?
agpl-3.0 ; 1 ; affero ; (?:gnu )?affero general public licen[sc]e (?:version |v )?3(?: 0)?
agpl-3.0 ; 1 ; agpl ; agpl (?:version |v )?3(?: 0)?
agpl-3.0 ; 1 ; agplv3 ; agplv3
agpl-3.0-only ; 1 ; agpl only ; agpl 3 0 only
agpl-3.0-or-later ; 1 ; agpl later ; agpl 3 0 or later
agpl ; 2 ; affero ; (?:gnu )?affero general public licen[sc]e
agpl ; 2 ; agpl ; (?:gnu )?agpl
gfdl-1.1 ; 1 ; gnu documentation ; gnu free documentation licen[sc]e version 1 1
gfdl-1.2 ; 1 ; gnu documentation ; gnu free documentation licen[sc]e version 1 2
gfdl-1.3 ; 1 ; gnu documentation ; gnu free documentation licen[sc]e version 1 3
gfdl ; 2 ; gnu documentation ; gnu free documentation licen[sc]e
gfdl ; 2 ; gfdl ; gfdl
mpl-1.0 ; 1 ; mozilla ; mozilla public licen[sc]e (?:version |v )?1 0
mpl-1.1 ; 1 ; mozilla ; mozilla public licen[sc]e (?:version |v )?1 1
mpl-2.0 ; 1 ; mozilla ; mozilla public licen[sc]e (?:version |v )?2 0
mpl-1.1 ; 1 ; mpl ; mpl (?:version |v )?1 1
mpl-2.0 ; 1 ; mpl ; mpl (?:version |v )?2 0
mpl ; 2 ; mozilla ; mozilla public licen[sc]e
npl-1.1 ; 1 ; netscape ; netscape public licen[sc]e (?:version |v )?1 1
npl ; 2 ; netscape ; netscape public licen[sc]e
epl-1.0 ; 1 ; eclipse ; eclipse public licen[sc]e (?:version |v )?1 0
epl-2.0 ; 1 ; eclipse ; eclipse public licen[sc]e (?:version |v )?2 0
epl-1.0 ; 1 ; epl ; epl (?:version |v )?1 0
epl-2.0 ; 1 ; epl ; epl (?:version |v )?2 0
epl ; 2 ; eclipse ; eclipse public licen[sc]e
edl-1.0 ; 2 ; eclipse distribution ; eclipse distribution licen[sc]e(?: (?:version |v )?1 0)?
cddl-1.0 ; 1 ; cddl ; cddl (?:version |v )?1 0
cddl-1.1 ; 1 ; cddl ; cddl (?:version |v )?1 1
cddl-1.0 ; 1 ; development distribution ; common development and distribution licen[sc]e (?:version |v )?1 0
cddl ; 2 ; development distribution ; common development and distribution licen[sc]e
cddl ; 2 ; cddl ; cddl
cpl-1.0 ; 1 ; common public ; common public licen[sc]e(?: version)? 1 0
cpl ; 2 ; common public ; common public licen[sc]e
cpal-1.0 ; 2 ; common attribution ; common public attribution licen[sc]e(?: version 1 0)?
ipl-1.0 ; 2 ; ibm ; ibm public licen[sc]e(?: version 1 0)?
spl-1.0 ; 2 ; sun public ; sun public licen[sc]e(?: version 1 0)?
sissl ; 2 ; sun industry ; sun industry standards source licen[sc]e
eupl-1.0 ; 1 ; eupl ; eupl (?:version |v )?1 0
eupl-1.1 ; 1 ; eupl ; eupl (?:version |v )?1 1
eupl-1.2 ; 1 ; eupl ; eupl (?:version |v )?1 2
eupl ; 2 ; european union ; european union public licen[sc]e
eupl ; 2 ; eupl ; eupl
cecill-1.0 ; 1 ; cecill ; cecill (?:version |v )?1(?: 0)?
cecill-2.1 ; 1 ; cecill ; cecill (?:version |v )?2 1
cecill-b ; 1 ; cecill ; cecill b
cecill-c ; 1 ; cecill ; cecill c
cecill ; 2 ; cecill ; cecill(?: free software)?(?: licen[sc]e)?
afl-2.1 ; 1 ; academic ; academic free licen[sc]e (?:version |v )?2 1
afl-3.0 ; 1 ; academic ; academic free licen[sc]e (?:version |v )?3 0
afl ; 2 ; academic ; academic free licen[sc]e
osl-2.1 ; 1 ; open software ; open software licen[sc]e (?:version |v )?2 1
osl-3.0 ; 1 ; open software ; open software licen[sc]e (?:version |v )?3 0
osl ; 2 ; open software ; open software licen[sc]e
artistic-1.0 ; 1 ; artistic ; artistic licen[sc]e (?:version |v )?1 0
artistic-2.0 ; 1 ; artistic ; artistic licen[sc]e (?:version |v )?2 0
artistic ; 2 ; artistic ; (?:perl )?artistic licen[sc]e
artistic ; 1 ; perl itself ; under the same terms as perl itself
bsl-1.0 ; 1 ; boost ; boost software licen[sc]e (?:version |v )?1 0
bsl-1.0 ; 2 ; boost ; boost (?:software )?licen[sc]e
busl-1.1 ; 1 ; business source ; business source licen[sc]e (?:version |v )?1 1
busl ; 2 ; business source ; business source licen[sc]e
sspl-1.0 ; 1 ; sspl ; sspl(?: (?:version |v )?1 0)?
sspl-1.0 ; 2 ; server side public ; server side public licen[sc]e
elastic-2.0 ; 1 ; elastic ; elastic licen[sc]e (?:version |v )?2 0
elastic ; 2 ; elastic ; elastic licen[sc]e
commons-clause ; 1 ; commons clause ; commons clause(?: license)?(?: condition)?
polyform-noncommercial ; 1 ; polyform ; polyform noncommercial licen[sc]e(?: 1 0 0)?
polyform-small-business ; 1 ; polyform ; polyform small business licen[sc]e(?: 1 0 0)?
polyform ; 2 ; polyform ; polyform [a-z ]{1,30}? licen[sc]e
confluent ; 2 ; confluent ; confluent community licen[sc]e
redis-sal ; 2 ; redis source ; redis source available licen[sc]e
fsl-1.1 ; 2 ; functional source ; functional source licen[sc]e
parity-7.0 ; 2 ; parity ; parity public licen[sc]e(?: 7 0 0)?
prosperity-3.0 ; 2 ; prosperity ; prosperity public licen[sc]e(?: 3 0 0)?
unlicense ; 1 ; unlicense ; unlicense
unlicense ; 1 ; unencumbered ; this is free and unencumbered software released into the public domain
wtfpl ; 1 ; wtfpl ; wtfpl
wtfpl ; 1 ; fuck want ; do what the fuck you want to(?: public license)?
zlib ; 2 ; zlib ; zlib(?: libpng)? licen[sc]e
zlib ; 1 ; misrepresented ; the origin of this software must not be misrepresented
libpng ; 2 ; libpng ; libpng licen[sc]e(?: version 2)?
libtiff ; 2 ; libtiff ; libtiff licen[sc]e
ijg ; 2 ; independent jpeg ; independent jpeg group(?: s)?(?: license)?
curl ; 2 ; curl ; curl licen[sc]e
openssl ; 2 ; openssl ; openssl licen[sc]e
openssl ; 1 ; openssl toolkit ; software developed by the openssl project for use in the openssl toolkit
ssleay ; 2 ; ssleay ; (?:original )?ssleay licen[sc]e
icu ; 2 ; icu ; icu licen[sc]e
unicode ; 2 ; unicode ; unicode (?:data files and software )?licen[sc]e(?: (?:agreement|v3))?
w3c ; 2 ; w3c ; w3c (?:software )?(?:and document )?(?:notice and )?licen[sc]e
ncsa ; 2 ; ncsa ; (?:university of illinois )?ncsa(?: open source)? licen[sc]e
psf-2.0 ; 2 ; python foundation ; python software foundation licen[sc]e(?: version 2)?
python-2.0 ; 1 ; python ; python licen[sc]e 2 0
cnri-python ; 2 ; cnri ; cnri (?:python )?(?:open source )?licen[sc]e
ruby ; 2 ; ruby ; ruby licen[sc]e
ruby ; 1 ; ruby ; under the same terms as ruby(?: itself)?
php-3.0 ; 1 ; php ; php licen[sc]e (?:version |v )?3 0
php-3.01 ; 1 ; php ; php licen[sc]e (?:version |v )?3 01
php ; 2 ; php ; php licen[sc]e
zend-2.0 ; 2 ; zend ; zend (?:engine )?licen[sc]e(?: version 2 0)?
postgresql ; 2 ; postgresql ; postgresql licen[sc]e
tcl ; 2 ; tcl ; tcl tk licen[sc]e
vim ; 2 ; vim ; vim licen[sc]e
sleepycat ; 2 ; sleepycat ; sleepycat licen[sc]e
qpl-1.0 ; 1 ; q public ; q public licen[sc]e(?: version 1 0)?
qpl-1.0 ; 2 ; qpl ; qpl(?: 1 0)?
nokia ; 2 ; nokia ; nokia open source licen[sc]e
zpl-1.1 ; 1 ; zope ; zope public licen[sc]e (?:zpl )?(?:version |v )?1 1
zpl-2.0 ; 1 ; zope ; zope public licen[sc]e (?:zpl )?(?:version |v )?2 0
zpl-2.1 ; 1 ; zope ; zope public licen[sc]e (?:zpl )?(?:version |v )?2 1
zpl ; 2 ; zope ; zope public licen[sc]e
lppl-1.0 ; 1 ; latex project ; latex project public licen[sc]e (?:version |v )?1 0
lppl-1.3 ; 1 ; latex project ; latex project public licen[sc]e (?:version |v )?1 3[a-c]?
lppl ; 2 ; latex project ; latex project public licen[sc]e
lppl ; 2 ; lppl ; lppl
ofl-1.0 ; 1 ; sil open font ; sil open font licen[sc]e (?:version |v )?1 0
ofl-1.1 ; 1 ; sil open font ; sil open font licen[sc]e (?:version |v )?1 1
ofl ; 2 ; open font ; (?:sil )?open font licen[sc]e
ubuntu-font ; 2 ; ubuntu font ; ubuntu font licen[sc]e(?: 1 0)?
bitstream-vera ; 2 ; bitstream vera ; bitstream vera (?:fonts? )?(?:copyright|license)
ms-pl ; 1 ; microsoft public ; microsoft public licen[sc]e(?: ms pl)?
ms-rl ; 1 ; microsoft reciprocal ; microsoft reciprocal licen[sc]e(?: ms rl)?
ms-lpl ; 1 ; microsoft limited ; microsoft limited public licen[sc]e
ms-eula ; 2 ; microsoft terms ; microsoft software license terms
apsl-1.2 ; 1 ; apple source ; apple public source licen[sc]e (?:version |v )?1 2
apsl-2.0 ; 1 ; apple source ; apple public source licen[sc]e (?:version |v )?2 0
apsl ; 2 ; apple source ; apple public source licen[sc]e
intel-osl ; 2 ; intel ; intel open source licen[sc]e
intel-simplified ; 2 ; intel simplified ; intel simplified software licen[sc]e
nvidia ; 2 ; nvidia ; nvidia (?:software |source code )licen[sc]e(?: agreement)?
oracle-bcl ; 2 ; oracle ; oracle binary code licen[sc]e(?: agreement)?
upl-1.0 ; 2 ; universal permissive ; universal permissive licen[sc]e(?: (?:version |v )?1 0)?
nasa-1.3 ; 2 ; nasa ; nasa open source agreement(?: version 1 3)?
rpl-1.5 ; 2 ; reciprocal ; reciprocal public licen[sc]e(?: 1 5)?
ecl-2.0 ; 2 ; educational community ; educational community licen[sc]e(?: version 2 0)?
jsr-spec ; 2 ; java community specification ; java community process specification licen[sc]e
json ; 1 ; good evil ; the software shall be used for good not evil
beerware ; 1 ; beer ; beer ware licen[sc]e
beerware ; 1 ; buy beer ; you can buy me a beer in return
mulan-psl-2.0 ; 2 ; mulan ; mulan permissive software licen[sc]e(?: (?:version |v )?2)?
blueoak-1.0 ; 2 ; blue oak ; blue oak model licen[sc]e(?: 1 0 0)?
hippocratic ; 2 ; hippocratic ; hippocratic licen[sc]e(?: (?:version |v )?[123])?
odbl-1.0 ; 1 ; odbl ; odbl(?: (?:version |v )?1 0)?
odbl-1.0 ; 2 ; open database ; open database licen[sc]e
odc-by-1.0 ; 2 ; open data attribution ; open data commons attribution licen[sc]e
pddl-1.0 ; 2 ; domain dedication ; (?:open data commons )?public domain dedication and licen[sc]e
ogl-uk-3.0 ; 1 ; open government ; open government licen[sc]e (?:version |v )?3 0
ogl-uk ; 2 ; open government ; open government licen[sc]e
etalab-2.0 ; 2 ; etalab ; (?:licence ouverte )?etalab(?: licence)?(?: 2 0)?
dl-de-by-2.0 ; 2 ; datenlizenz ; datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)?
openrail ; 2 ; openrail ; (?:bigscience |creativeml )?openrail(?: m| d| s)?(?: licen[sc]e)?
llama-community ; 2 ; llama community ; llama (?:[23] )?community licen[sc]e(?: agreement)?
gemma-terms ; 2 ; gemma ; gemma terms of use
cc0-1.0 ; 1 ; cc0 ; cc0(?: 1 0)?(?: universal)?
cc0-1.0 ; 1 ; creative zero ; creative commons (?:cc )?zero
cc-by-1.0 ; 1 ; cc by ; cc by 1 0
cc-by-2.0 ; 1 ; cc by ; cc by 2 0
cc-by-2.5 ; 1 ; cc by ; cc by 2 5
cc-by-3.0 ; 1 ; cc by ; cc by 3 0
cc-by-4.0 ; 1 ; cc by ; cc by 4 0
cc-by-sa-2.0 ; 1 ; cc sa ; cc by sa 2 0
cc-by-sa-2.5 ; 1 ; cc sa ; cc by sa 2 5
cc-by-sa-3.0 ; 1 ; cc sa ; cc by sa 3 0
cc-by-sa-4.0 ; 1 ; cc sa ; cc by sa 4 0
cc-by-nd-3.0 ; 1 ; cc nd ; cc by nd 3 0
cc-by-nd-4.0 ; 1 ; cc nd ; cc by nd 4 0
cc-by-nc-2.0 ; 1 ; cc nc ; cc by nc 2 0
cc-by-nc-3.0 ; 1 ; cc nc ; cc by nc 3 0
cc-by-nc-4.0 ; 1 ; cc nc ; cc by nc 4 0
cc-by-nc-sa-3.0 ; 1 ; cc nc sa ; cc by nc sa 3 0
cc-by-nc-sa-4.0 ; 1 ; cc nc sa ; cc by nc sa 4 0
cc-by-nc-nd-3.0 ; 1 ; cc nc nd ; cc by nc nd 3 0
cc-by-nc-nd-4.0 ; 1 ; cc nc nd ; cc by nc nd 4 0
cc-by-sa ; 2 ; cc sa ; cc by sa
cc-by-nd ; 2 ; cc nd ; cc by nd
cc-by-nc-sa ; 2 ; cc nc sa ; cc by nc sa
cc-by-nc-nd ; 2 ; cc nc nd ; cc by nc nd
cc-by ; 3 ; cc by ; cc by
cc-by-4.0 ; 1 ; creative attribution ; creative commons attribution 4 0(?: international)?
cc-by-3.0 ; 1 ; creative attribution ; creative commons attribution 3 0(?: unported)?
cc-by-sa-4.0 ; 1 ; creative sharealike ; creative commons attribution sharealike 4 0(?: international)?
cc-by-sa ; 2 ; creative alike ; creative commons attribution share alike
cc-by-sa ; 2 ; creative sharealike ; creative commons attribution sharealike
cc-by-nc ; 2 ; creative attribution ; creative commons attribution non ?commercial
cc-by-nc-sa ; 1 ; creative attribution ; creative commons attribution non ?commercial share ?alike
cc-by-nc-nd ; 1 ; creative attribution ; creative commons attribution non ?commercial no ?deriv(?:ative)?s?
cc-by ; 2 ; creative attribution ; creative commons attribution(?: license)?
cc-by ; 2 ; creativecommons by ; creativecommons org licenses by(?: [1-4] [05])?
cc-by-sa ; 2 ; creativecommons sa ; creativecommons org licenses by sa(?: [1-4] [05])?
cc-by-nc ; 2 ; creativecommons nc ; creativecommons org licenses by nc(?: [1-4] [05])?
cc-unspecified ; 3 ; creative commons ; creative commons(?: license)?
public-domain ; 2 ; public domain ; (?:released |dedicated |placed )?(?:in |into |to )?the public domain
proprietary ; 2 ; confidential proprietary ; (?:proprietary and confidential|confidential and proprietary)
proprietary ; 2 ; unauthorized copying ; unauthorized copying of this (?:file|software|document)
proprietary ; 3 ; rights reserved ; all rights reserved
proprietary ; 3 ; internal use only ; for internal use only
non-commercial ; 2 ; non commercial ; for non commercial (?:use|purposes)(?: only)?
non-commercial ; 2 ; noncommercial ; for noncommercial (?:use|purposes)(?: only)?
non-commercial ; 2 ; personal use only ; for personal use only
no-derivatives ; 3 ; derivative permitted ; no derivative works (?:are )?permitted
attribution-required ; 3 ; attribution required ; attribution is required
unspecified ; 3 ; see details ; see (?:the )?licen[sc]e(?: file)? for (?:more )?details
unspecified ; 3 ; licensed under terms ; licensed under the terms
unspecified ; 3 ; released under terms ; released under the terms
unspecified ; 3 ; distributed terms ; distributed under the terms of
spdx-tag ; 3 ; spdx ; spdx license identifier [a-z0-9]+
"""
